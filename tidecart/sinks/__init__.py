from tidecart.sinks.day_index import DayIndex
from tidecart.sinks.ledger import CounterLedger, Fenced, FirstLedger, KeyedLedger, SetLedger
from tidecart.sinks.topics import FileTopics, KafkaTopics

__all__ = ["CounterLedger", "DayIndex", "Fenced", "FileTopics", "FirstLedger", "KafkaTopics", "KeyedLedger", "SetLedger"]
