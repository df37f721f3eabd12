from tidecart.sources import files, kafka

__all__ = ["files", "kafka"]
