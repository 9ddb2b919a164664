"""Readers and writers of documents, lexicons and treebanks."""
