from .changes import ChangeTarget
from .flows import Sink, finish, into_sink, into_table, snapshot_to_sink

__all__ = ["ChangeTarget", "Sink", "finish", "into_sink", "into_table", "snapshot_to_sink"]
