"""Health-plan price-transparency analytics on Spark DataFrames."""

from ratescape.functions.profiles import BenchmarkPolicy, CodeProfile, get_profile, list_profiles
from ratescape.operators.rate_query import run_query, summarize

__all__ = [
    "BenchmarkPolicy",
    "CodeProfile",
    "get_profile",
    "list_profiles",
    "run_query",
    "summarize",
]
