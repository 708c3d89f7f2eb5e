from loadsmith.streaming.documents_stream import read_ingested, start_document_stream
from loadsmith.streaming.scd_stream import latest_per_window, scd_micro_batches, start_scd_stream

__all__ = ["latest_per_window", "read_ingested", "scd_micro_batches", "start_document_stream", "start_scd_stream"]
