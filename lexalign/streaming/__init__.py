"""Incremental runs.

The reference has no streaming (no watermarks, windows or state).  Its only incremental
notion is ``skip_existing``: a stage re-run skips units whose output file exists.  Here a
re-run is a batch anti-join of the work list against *committed* outputs (a ``_SUCCESS``
marker), see :func:`lexalign.streaming.incremental.pending_units`.
"""
