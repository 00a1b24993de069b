from .ingest import freeze_static, stream_ingest
from .revised import changed_files, ingest_revised, read_ingested

__all__ = ["changed_files", "freeze_static", "ingest_revised", "read_ingested", "stream_ingest"]
