"""Readers and writers of transcripts, logs, ledgers and digests."""
