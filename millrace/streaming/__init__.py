from .codec import decode_payload, encode_payload
from .flow import consume, parse_records, publish, read_record_stream, read_stream, to_records, track_stream

__all__ = [
    "decode_payload", "encode_payload", "consume", "parse_records", "publish", "read_record_stream",
    "read_stream", "to_records", "track_stream",
]
