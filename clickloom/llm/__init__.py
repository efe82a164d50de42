"""Operators of a training-data pipeline over documents, conversations and embeddings."""

import pyarrow as pa

# Freed batches go back to the system at once: a worker then holds some 150 MB, with the default pool 500 MB.
pa.set_memory_pool(pa.system_memory_pool())
