"""DataFrame -> DataFrame operators: relational, spatial, graph and mesh. Every order-dependent operator takes its order explicitly."""
