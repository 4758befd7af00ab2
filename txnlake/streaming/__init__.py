"""Incremental loading.

The reference has no streams. The one place a stream fits its semantics is
the load: new raw files arriving in a folder are appended to the warehouse
with the same insert-ignore rules as a batch load (see ``incremental``).
"""
