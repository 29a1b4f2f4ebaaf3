"""Sources (landed JSON, route responses, configuration) and sinks (documents, CSV, Markdown, binary meshes)."""
