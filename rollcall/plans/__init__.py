"""The whole batch, and batch after batch."""

from rollcall.plans.batch import Mastered, master_feeds, publish
from rollcall.plans.incremental import Mastery, apply_all

__all__ = ["Mastered", "Mastery", "apply_all", "master_feeds", "publish"]
