"""Tables in the folder that all executors share, see betaloom.sources.scratch."""

from betaloom.sources.scratch import materialize, release, shared_dir, shuffle_partitions, temporary
from betaloom.sources.scratch import target as _target

__all__ = ["_target", "materialize", "release", "shared_dir", "shuffle_partitions", "temporary"]
