"""Mixing sources to target weights by hierarchical budgeting.

Documents hang under a tree of levels (here domain > language > source). The
token budget flows from the root down: at each node it is split among the
children by weight, a child never gets more than its subtree can give (its
tokens times ``max_epochs``), and what one child cannot use goes to its
siblings first. Only what a whole subtree cannot use is left for the siblings
of its ancestors, because capacities are summed bottom-up before budgets flow
down. Splits are exact integers; at most one token per node is lost to
rounding down.

A leaf's documents are then read in seeded epochs, each a permutation by a hash
of (seed, epoch, doc_id): whole epochs while the budget lasts, and of the last
epoch the longest prefix that fits. Prefixes are found from token sums of hash
buckets, so a leaf with a third of all documents is never sorted in one task:
only its one bucket at the cut is.

Everything is DataFrame functions; nothing is collected.

Edge cases: null levels become "(none)"; null and empty texts have no tokens
and follow the epochs' order like others; nodes with null or non-positive
weight get nothing; a budget beyond all capacity gives max_epochs of everything;
rows with a null doc_id hash as an empty id; repeated rows count each; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, Scratch

_BLANK = " \t\n\x0b\x0c\r"
NONE = "(none)"


def count_words(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(_BLANK))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, SPACES))).cast("long")


def split_budget(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Water-filling: children with columns parent..., name, budget (of the parent), cap and weight get ``share`` each."""
    big = "decimal(38,0)"
    ratio = F.col("cap").cast("double") / F.col("weight")
    by = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    order = by.orderBy(ratio, name)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    n = lambda c: F.col(c).cast(big)
    c = children.withColumn("used", F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn("heavy", F.sum("weight").over(after))
    # children in the order of capacity per weight: the full ones come first
    c = c.withColumn("full", n("cap") * n("heavy") <= (n("budget") - n("used")) * n("weight"))
    c = c.withColumn("taken", F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(by), F.lit(0))).withColumn("open", F.sum(F.when(~F.col("full"), F.col("weight"))).over(by))
    part = F.expr(f"((cast(budget as {big}) - cast(taken as {big})) * cast(weight as {big})) div cast(open as {big})")
    return c.withColumn("share", F.when(F.col("full"), F.col("cap")).otherwise(F.least(part, F.col("cap")))).drop("used", "heavy", "full", "taken", "open")


def leaf_budgets(tokens: DataFrame, levels: list[str], weights: list[Column], share: tuple[int, int], max_epochs: int) -> DataFrame:
    """(levels..., total, share) of every leaf. tokens: levels..., n_tokens; the budget is share[0]/share[1] of all tokens."""
    leaves = tokens.groupBy(*levels).agg(F.sum("n_tokens").alias("total")).withColumn("cap", F.col("total") * max_epochs)
    for k, w in enumerate(weights):
        leaves = leaves.withColumn(f"__w{k}", w.cast("long"))
    live = F.lit(True)
    for k in range(len(weights)):
        live &= F.coalesce(F.col(f"__w{k}"), F.lit(0)) > 0
    leaves = leaves.withColumn("cap", F.when(live, F.col("cap")).otherwise(F.lit(0)))
    whole = leaves.agg(F.expr(f"cast(sum(cast(total as decimal(38,0))) * {share[0]} div {share[1]} as bigint)").alias("budget"))
    given = None
    for k, level in enumerate(levels):
        path = levels[: k + 1]
        nodes = leaves.where("cap > 0").groupBy(*path).agg(F.sum("cap").alias("cap"), F.max(f"__w{k}").alias("weight"))
        if given is None:
            nodes = nodes.join(F.broadcast(whole))  # one row
        else:
            nodes = nodes.join(given.withColumnRenamed("share", "budget"), levels[:k])
        given = split_budget(nodes, levels[:k], level).select(*path, "share")
    return leaves.select(*levels, "total").join(given, levels)


def order_key(seed: int, epoch: Column, doc: Column) -> Column:
    """52 bits of md5("seed|epoch|doc")."""
    text = F.concat_ws("|", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def mix(docs: DataFrame, levels: dict[str, Column], weights: list[Column], share: tuple[int, int], max_epochs: int = 3, seed: int = 17, bits: int = 12, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(doc_id, levels..., n_tokens, copies) of every document that the mix reads at least once.

    levels: name -> Column over docs, from the root down. weights: one Column
    per level over the level names, the weight of a node among its siblings.
    """
    scratch = Scratch(docs.sparkSession, "mixing")
    names = list(levels)
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), *(F.coalesce(c.cast("string"), F.lit(NONE)).alias(n) for n, c in levels.items()), count_words(F.col(text_col)).alias("n_tokens"))
    own = scratch.save(own, "tokens")
    budgets = scratch.save(leaf_budgets(own, names, weights, share, max_epochs), "budgets")
    rest = F.when(F.col("total") > 0, F.col("share") - F.expr("share div total") * F.col("total")).otherwise(F.lit(0))
    leaf = budgets.where("share > 0").select(*names, F.expr("share div total").alias("whole"), rest.alias("rest"))
    rows = own.join(leaf, names).withColumn("key", order_key(seed, F.col("whole"), F.col("doc_id")))
    rows = scratch.save(rows.withColumn("bucket", F.shiftright("key", 52 - bits).cast("int")), "rows")
    sums = rows.groupBy(*names, "bucket").agg(F.sum("n_tokens").alias("n"), F.max("rest").alias("rest"))
    upto = F.sum("n").over(Window.partitionBy(*names).orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    sums = sums.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))
    # buckets wholly inside the prefix, and the one at the cut
    cut = sums.where("before <= rest").select(*names, "bucket", (F.col("upto") <= F.col("rest")).alias("inside"), "before")
    met = rows.join(cut, [*names, "bucket"], "left")
    at_cut = met.where("inside = false").withColumn("sum", F.col("before") + F.sum("n_tokens").over(Window.partitionBy(*names, "bucket").orderBy("key", "doc_id", "n_tokens").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    out = [*(F.col(c) for c in ("doc_id", *names, "n_tokens"))]
    sure = met.where("inside is null or inside").select(*out, (F.col("whole") + F.coalesce("inside", F.lit(False)).cast("int")).cast("int").alias("copies"))
    edge = at_cut.select(*out, (F.col("whole") + (F.col("sum") <= F.col("rest")).cast("int")).cast("int").alias("copies"))
    return sure.unionByName(edge).where("copies > 0")


# --- the query's tree: fixed values ---
DOMAINS = ("web", "reference", "forum")
DOMAIN_WEIGHTS = {"web": 5, "reference": 3, "forum": 2}
LANG_WEIGHTS = {"en": 6, "de": 2, "fr": 1, "es": 1}
SHARE, EPOCHS, SEED = (3, 5), 3, 17


def _case(column: str, values: dict[str, int], other: int) -> Column:
    out = F.lit(other)
    for k, v in values.items():
        out = F.when(F.col(column) == k, v).otherwise(out)
    return out


def mix_documents(docs: DataFrame) -> DataFrame:
    """The production mix of ``documents``: domain (from the source's number), language, source."""
    number = F.expr("try_cast(nullif(regexp_extract(source, '([0-9]+)$', 1), '') as bigint)")
    domain = F.when(number.isNull(), "other").otherwise(F.element_at(F.array(*map(F.lit, DOMAINS)), (number % len(DOMAINS) + 1).cast("int")))
    levels = {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}
    return mix(docs, levels, [_case("domain", DOMAIN_WEIGHTS, 1), _case("lang", LANG_WEIGHTS, 1), F.lit(1)], SHARE, EPOCHS, SEED)


def oracle(documents: str = "documents") -> str:
    """DuckDB SQL of the production mix over a table or subquery."""
    weights = lambda col, values: f"CASE {col} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in values.items()) + " ELSE 1 END"
    chars = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

    def fill(k: int, parent: str, name: str, nodes: str) -> str:
        by = f"PARTITION BY {parent}" if parent else ""
        return f"""
a{k} AS (SELECT *, coalesce(sum(cap) OVER ({by} ORDER BY cap::DOUBLE / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS used,
            sum(weight) OVER ({by} ORDER BY cap::DOUBLE / weight, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS heavy FROM ({nodes})),
b{k} AS (SELECT *, cap::HUGEINT * heavy <= (budget::HUGEINT - used) * weight AS is_full FROM a{k}),
c{k} AS (SELECT *, coalesce(sum(CASE WHEN is_full THEN cap END) OVER ({by}), 0) AS taken, sum(CASE WHEN NOT is_full THEN weight END) OVER ({by}) AS open FROM b{k}),
n{k} AS (SELECT * EXCLUDE (used, heavy, is_full, taken, open),
            (CASE WHEN is_full THEN cap ELSE least((budget::HUGEINT - taken) * weight // open, cap) END)::BIGINT AS share FROM c{k})"""

    return f"""
WITH t AS (SELECT doc_id, coalesce(lang, '{NONE}') AS lang, coalesce(source, '{NONE}') AS source,
             trim(coalesce(text, ''), {chars}) AS x,
             try_cast(nullif(regexp_extract(coalesce(source, ''), '([0-9]+)$', 1), '') AS BIGINT) AS num FROM {documents}),
own AS (SELECT doc_id, CASE WHEN num IS NULL THEN 'other' ELSE {list(DOMAINS)}[num % {len(DOMAINS)} + 1] END AS domain, lang, source,
             CASE WHEN x = '' THEN 0 ELSE len(string_split_regex(x, '[ \\t\\n\\x0B\\f\\r]+')) END::BIGINT AS n_tokens FROM t),
leaves AS (SELECT domain, lang, source, sum(n_tokens)::BIGINT AS total, (sum(n_tokens) * {EPOCHS})::BIGINT AS cap FROM own GROUP BY ALL),
whole AS (SELECT (sum(total)::HUGEINT * {SHARE[0]} // {SHARE[1]})::BIGINT AS budget FROM leaves),{fill(0, "", "domain", f"SELECT domain, sum(cap)::BIGINT AS cap, {weights('domain', DOMAIN_WEIGHTS)} AS weight, any_value(budget) AS budget FROM leaves, whole WHERE cap > 0 GROUP BY domain")},{fill(1, "domain", "lang", f"SELECT l.domain, l.lang, sum(l.cap)::BIGINT AS cap, {weights('l.lang', LANG_WEIGHTS)} AS weight, any_value(p.share) AS budget FROM leaves l JOIN n0 p USING (domain) WHERE l.cap > 0 GROUP BY l.domain, l.lang")},{fill(2, "domain, lang", "source", "SELECT l.domain, l.lang, l.source, l.cap, 1 AS weight, p.share AS budget FROM leaves l JOIN n1 p USING (domain, lang) WHERE l.cap > 0")},
leaf AS (SELECT domain, lang, source, n2.share // total AS whole, n2.share % total AS rest FROM n2 JOIN leaves USING (domain, lang, source) WHERE n2.share > 0),
r AS (SELECT own.*, whole, rest, ('0x' || substr(md5('{SEED}|' || whole || '|' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT AS key FROM own JOIN leaf USING (domain, lang, source)),
s AS (SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY key, doc_id, n_tokens ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM r)
SELECT doc_id, domain, lang, source, n_tokens, (whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END)::INTEGER AS copies
FROM s WHERE whole + CASE WHEN upto <= rest THEN 1 ELSE 0 END > 0
"""
