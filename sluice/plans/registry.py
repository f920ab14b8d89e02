"""Which datasets a pipeline moves, and where everything lies."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from sluice.plans.contract import Contract
from sluice.streaming.ingest import KEEP_ALL, MAX_FILES

# What may become of a file that was taken up.
KEEP, ARCHIVE, DELETE = "keep", "archive", "delete"


@dataclass(frozen=True)
class Dataset:
    """One landing directory, its raw table and its typed table.

    ``when_taken`` says what becomes of a landed file that a committed version holds: ``keep``,
    ``archive`` (moved under ``Layout.archive``) or ``delete``.
    """

    name: str
    raw_name: str
    contract: Contract | None = None
    csv_options: Mapping[str, str] = field(default_factory=dict)
    max_files: int = MAX_FILES
    max_file_age: str = KEEP_ALL
    when_taken: str = KEEP
    bucket_bytes: int | None = None
    on_duplicate: str = "latest"
    strict: bool = False
    ignore_case: bool = False
    keep_when_missing: bool = False

    def __post_init__(self) -> None:
        if self.on_duplicate not in ("latest", "error"):
            raise ValueError(f"on_duplicate is 'latest' or 'error', not {self.on_duplicate!r}")
        if self.when_taken not in (KEEP, ARCHIVE, DELETE):
            raise ValueError(f"when_taken is {KEEP!r}, {ARCHIVE!r} or {DELETE!r}, not {self.when_taken!r}")

    @property
    def typed_name(self) -> str:
        return f"{self.name}_silver"


@dataclass(frozen=True)
class Layout:
    """Directories of a pipeline; all of them in storage every executor sees.

    The archive must be in the same file system as the landing directory, and not within it.
    """

    landing: str
    raw: str
    typed: str
    checkpoints: str
    archive: str | None = None

    @classmethod
    def under(cls, root: str) -> Layout:
        root = root.rstrip("/")
        return cls(f"{root}/landing", f"{root}/raw", f"{root}/typed", f"{root}/checkpoints", f"{root}/archive")

    def landing_of(self, dataset: Dataset) -> str:
        return _join(self.landing, dataset.name)

    def raw_of(self, dataset: Dataset) -> str:
        return _join(self.raw, dataset.raw_name)

    def typed_of(self, dataset: Dataset) -> str:
        return _join(self.typed, dataset.typed_name)

    def checkpoint_of(self, dataset: Dataset) -> str:
        return _join(self.checkpoints, dataset.name)

    def cleaning_of(self, dataset: Dataset) -> dict[str, str]:
        """Options of the file source for what is to become of the files that were taken up."""
        if dataset.when_taken == ARCHIVE:
            if self.archive is None:
                raise ValueError(f"dataset {dataset.name} archives its files, but the layout has no archive")
            return {"cleanSource": ARCHIVE, "sourceArchiveDir": _join(self.archive, dataset.name)}
        return {"cleanSource": DELETE} if dataset.when_taken == DELETE else {}

def _join(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"

def read_registry(
    entries: Iterable[Mapping], definitions: Mapping[str, Mapping], **options
) -> tuple[list[Dataset], list[Mapping]]:
    """Datasets from configuration entries, and the entries that are malformed.

    An entry has a ``subdir`` and a ``target_table``; ``definitions`` holds the contracts in
    their JSON form by subdir; an entry whose contract cannot be built is malformed too.
    ``compat_types`` and the fields of ``Dataset`` are options.
    """
    compat_types = options.pop("compat_types", False)
    good, bad = [], []
    for entry in entries:
        name, raw_name = entry.get("subdir"), entry.get("target_table")
        if not name or not raw_name:
            bad.append(entry)
            continue
        definition = definitions.get(name)
        try:
            contract = Contract.from_dict(definition, compat_types) if definition else None
        except (KeyError, TypeError, ValueError, AttributeError):
            bad.append(entry)
            continue
        good.append(Dataset(name, raw_name, contract, **options))
    return good, bad

def shared_places(datasets: Iterable[Dataset]) -> dict[str, str]:
    """Dataset name -> what it shares with another: a landing directory or a raw table.

    Two streams into one raw table would write the same versions, so none of them may run.
    """
    known = list(datasets)
    names, raw_names = Counter(d.name for d in known), Counter(d.raw_name for d in known)
    found = {}
    for dataset in known:
        if names[dataset.name] > 1:
            found[dataset.name] = f"the name {dataset.name!r} is given to several datasets"
        elif raw_names[dataset.raw_name] > 1:
            found[dataset.name] = f"the raw table {dataset.raw_name!r} belongs to several datasets"
    return found
