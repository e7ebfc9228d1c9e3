"""Streaming: the batch operators over a file stream (see ``incremental``)."""
