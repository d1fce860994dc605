"""Incremental landing of provider responses (Structured Streaming).

The original job has no stream.  Responses, however, arrive over time, and
the per-response work (acceptance rule, field parsing) is stateless, so it
runs unchanged on a streaming DataFrame; the per-code decision and the
numbering stay batch jobs over the landed result.
"""
