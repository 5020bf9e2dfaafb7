"""A scope for persisted frames."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame


class FrameScope:
    """Owns the frames that a job persists and releases them on every way out
    of its ``with`` block: success, a blocked gate, a failed write.

    >>> with FrameScope() as frames:
    ...     summary = frames.keep(summary)

    Releasing does not wait for executors, and a frame that cannot be released
    does not keep the others, or the error on its way, from going out."""

    def __init__(self, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> None:
        self.level = level
        self._held: list[DataFrame] = []
        self.kept = 0
        """frames that were persisted so far"""

    @property
    def held(self) -> int:
        """Frames that are persisted now."""
        return len(self._held)

    def keep(self, df: DataFrame, when: bool = True) -> DataFrame:
        """``df``, persisted until the scope ends if ``when`` holds. A frame
        that somebody else has persisted is theirs and is left alone."""
        if not when or df.storageLevel != StorageLevel.NONE:
            return df
        kept = df.persist(self.level)
        self._held.append(kept)
        self.kept += 1
        return kept

    def release(self, df: DataFrame) -> None:
        """Give one frame back early."""
        self._held = [f for f in self._held if f is not df]
        df.unpersist()

    def __enter__(self) -> FrameScope:
        return self

    def __exit__(self, kind, error, trace) -> None:
        failed = None
        while self._held:
            try:
                self._held.pop().unpersist()
            except Exception as err:  # the others still go
                failed = failed or err
        if failed is not None and error is None:
            raise failed
