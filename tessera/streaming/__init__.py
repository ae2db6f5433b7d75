from .profile import latest_by_key, run_available_now, stream_profile
from .score import stream_score

__all__ = ["latest_by_key", "run_available_now", "stream_profile", "stream_score"]
