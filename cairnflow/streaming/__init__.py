"""Structured Streaming forms of the sequence operators: an extension, since batch is all that the operators' model needs."""
