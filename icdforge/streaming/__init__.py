"""Incremental (Structured Streaming) use of the code-set tables."""

from .claims_stream import CLAIM_SCHEMA, flag_claims, read_claim_files, start_flagging

__all__ = ["CLAIM_SCHEMA", "flag_claims", "read_claim_files", "start_flagging"]
