"""Physical-plan helpers: session settings, time slices for ordered scans, checkpoints."""

from fleetlens.plans.session import build_session, settings, settle
from fleetlens.plans.slices import Slices, ordered_scan, plan_slices

__all__ = ["Slices", "build_session", "ordered_scan", "plan_slices", "settings", "settle"]
