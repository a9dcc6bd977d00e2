"""Structured Streaming: the hinted JSON file source (``sources``),
watermarked windows (``windows``) and drain-and-stop sinks with the two-hop
Bronze -> Gold stream (``sinks``)."""
