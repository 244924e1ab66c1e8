"""Readers and writers: raw documents, processed tables, published versions."""
