from pathproof.sources.readers import read_between, read_input, read_risk_events, read_table
from pathproof.sources.sinks import replace_days, write_full, write_partitioned

__all__ = ["read_between", "read_input", "read_risk_events", "read_table", "replace_days", "write_full", "write_partitioned"]
