from pathproof.operators.asof import asof_lookup
from pathproof.operators.cuts import made_once
from pathproof.operators.intervals import holding, holding_each, interval_join, smallest_ends
from pathproof.operators.latest import latest_by
from pathproof.operators.neighbours import neighbours
from pathproof.operators.sampling import pick_per_class
from pathproof.operators.slots import DAY, HOUR, MINUTE, beyond_slots, slot, with_slot

__all__ = [
    "DAY",
    "HOUR",
    "MINUTE",
    "asof_lookup",
    "beyond_slots",
    "holding",
    "holding_each",
    "interval_join",
    "latest_by",
    "made_once",
    "neighbours",
    "pick_per_class",
    "slot",
    "smallest_ends",
    "with_slot",
]
