"""Incremental ingestion of landed count files.

The original work reads every input once; there is no streaming operator to reproduce.  What does recur in
practice is new count matrices landing in a folder, so ``ingest_counts`` runs the *same* wide-to-long step
(``operators.explode_wide``, zero cells dropped before the explode) as a Structured Streaming file-source
job.  With ``availableNow`` it processes whatever has landed and stops; its checkpoint lives in the shared
checkpoint folder, so a restarted job resumes exactly where it left off.
"""

from ecospark.streaming.counts import ingest_counts

__all__ = ["ingest_counts"]
