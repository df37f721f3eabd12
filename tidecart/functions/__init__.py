from tidecart.functions import labels, text, times

__all__ = ["labels", "text", "times"]
