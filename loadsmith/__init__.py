"""loadsmith — warehouse-loading operators on Spark DataFrames.

Every operator takes DataFrames and returns DataFrames; planning, shuffling,
spilling and code generation are left to Catalyst and AQE.
"""

from loadsmith.session import get_session, scratch_path
from loadsmith.specs import TrackedAttribute, Type6Spec, VersionedSpec

__all__ = [
    "get_session",
    "scratch_path",
    "TrackedAttribute",
    "Type6Spec",
    "VersionedSpec",
]
