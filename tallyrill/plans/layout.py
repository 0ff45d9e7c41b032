"""Paths and settings shared by the speed and batch plans."""

from __future__ import annotations

from dataclasses import dataclass, field

from tallyrill.models import COMMENT, MODELS, SERVING, SUBMISSION, TopicModel
from tallyrill.operators.ranking import TOP
from tallyrill.operators.windows import RSD, SIZE
from tallyrill.sources.offsets import STALE
from tallyrill.sources.serving import Serving
from tallyrill.sources.topics import Topics


@dataclass(frozen=True)
class Job:
    """One deployment.

    ``sources`` are the topics to land; ``kinds`` maps those to count and rank to their column
    in the ranking, each with a windowed table of its own. ``bucket_size`` sets
    how many offsets share a landing directory; choose it so that a directory holds about
    a gigabyte or more, since every directory and file costs the driver listing time.
    ``land_trigger`` (by default five minutes, or ``trigger`` where that runs once) sets how much
    one landed file can hold. After ``root_batches`` micro-batches landing goes on in a new root,
    which bounds what Spark lists. Without a ``generation`` a new checkpoint takes the next one.
    A batch run's claim is a crashed run's after ``stale_claim`` seconds.
    ``mode='FAILFAST'`` stops landing at a record that does not fit its model.
    """

    root: str
    topics: Topics
    bucket_size: int = 1_000_000
    size: str = SIZE
    watermark: str | None = None
    rsd: float = RSD
    generation: int | None = None
    trigger: dict[str, object] | None = None
    land_trigger: dict[str, object] | None = None
    root_batches: int = 1000
    mode: str = "PERMISSIVE"
    top: int = TOP
    stale_claim: float = STALE
    sources: tuple[str, ...] = (SUBMISSION.source, COMMENT.source)
    key: str = "subreddit"
    kinds: dict[str, str] = field(
        default_factory=lambda: {SUBMISSION.source: "submissions", COMMENT.source: "comments"}
    )
    store: Serving | None = None

    def __post_init__(self) -> None:
        for source, kind in self.kinds.items():
            if source not in self.sources:
                raise ValueError(f"{source} is to be counted, but not landed")
            if f"windowed_{kind}" not in SERVING:
                raise ValueError(f"there is no serving table windowed_{kind}")
            if self.key not in MODELS[source].keys:
                raise ValueError(f"records of {source} have no {self.key}")

    @property
    def models(self) -> dict[str, TopicModel]:
        """The landed topics."""
        return {source: MODELS[source] for source in self.sources}

    @property
    def ranked(self) -> dict[str, TopicModel]:
        """The counted and ranked topics."""
        return {source: MODELS[source] for source in self.kinds}

    @property
    def landing(self) -> dict[str, object] | None:
        """The landing trigger."""
        once = self.trigger and ("availableNow" in self.trigger or "once" in self.trigger)
        return self.land_trigger or (self.trigger if once else {"processingTime": "5 minutes"})

    @property
    def landed(self) -> str:
        return f"{self.root}/landed"

    @property
    def offsets(self) -> str:
        return f"{self.root}/offsets"

    @property
    def serving(self) -> Serving:
        return self.store or Serving(f"{self.root}/serving")

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/checkpoints/{query}"
