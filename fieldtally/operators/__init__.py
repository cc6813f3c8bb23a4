from fieldtally.operators.graph import (
    both_directions,
    frontier_messages,
    hops_histogram,
    merge_state,
    seed,
    shortest_paths,
    unsettled,
    vertices,
)
from fieldtally.operators.motion import (
    avg_step,
    best_window,
    only_entities,
    rollup_exits,
    running_best,
    step_distances,
    zone_exits,
    zone_flags,
)
from fieldtally.operators.ordered import ranked, with_previous
from fieldtally.operators.relational import (
    avg_per_entity,
    entities_without,
    existence_flags,
    facts_with_entities,
    filter_above,
    filter_since,
    sum_and_count,
    tagged_avg,
)
from fieldtally.operators.zones import with_zones, zone_table_exits

__all__ = [
    "avg_per_entity",
    "avg_step",
    "best_window",
    "both_directions",
    "entities_without",
    "existence_flags",
    "facts_with_entities",
    "filter_above",
    "filter_since",
    "frontier_messages",
    "hops_histogram",
    "merge_state",
    "only_entities",
    "ranked",
    "rollup_exits",
    "running_best",
    "seed",
    "shortest_paths",
    "step_distances",
    "sum_and_count",
    "tagged_avg",
    "unsettled",
    "vertices",
    "with_previous",
    "with_zones",
    "zone_exits",
    "zone_flags",
    "zone_table_exits",
]
