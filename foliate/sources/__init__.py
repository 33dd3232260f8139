"""Readers, payload decoders and write-once tables."""
