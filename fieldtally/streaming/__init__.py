from fieldtally.streaming.motion import best_so_far, read_best, stream_avg_step, stream_zone_exits, track_best
from fieldtally.streaming.runner import finish_positions, finish_stream, run_to_the_end
from fieldtally.streaming.tail import account, by_slices, closed_avg_step, closed_zone_exits, live_running_best, results, set_aside

__all__ = [
    "account", "best_so_far", "by_slices", "closed_avg_step", "closed_zone_exits", "finish_positions", "finish_stream", "live_running_best",
    "read_best", "results", "run_to_the_end", "set_aside", "stream_avg_step", "stream_zone_exits", "track_best",
]
