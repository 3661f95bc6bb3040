"""Text and speech-corpus analytics as Spark plans."""
