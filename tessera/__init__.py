"""Tessera: verified parameter records from scientific documents, as Spark plans."""
