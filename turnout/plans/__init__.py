from turnout.plans.marts import MART_NAMES, build_marts, run_stages
from turnout.plans.stages import clean, clean_typed, normalize, scope, type_calls

__all__ = [
    "MART_NAMES", "build_marts", "clean", "clean_typed", "normalize", "run_stages", "scope",
    "type_calls",
]
