"""Tables and jobs as the user describes them, with the checks made before any data is read."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass, field
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import types as T


class Violation(NamedTuple):
    rule: str
    message: str


class SpecError(ValueError):
    def __init__(self, violations: list[Violation]) -> None:
        super().__init__("; ".join(f"{v.rule}: {v.message}" for v in violations))
        self.violations = violations


@dataclass(frozen=True)
class TableSpec:
    """A keyed table: its columns, its partition key and clustering key, and its counter columns."""

    name: str
    schema: T.StructType
    partition_key: tuple[str, ...]
    clustering_key: tuple[str, ...] = ()
    counters: frozenset[str] = frozenset()

    @classmethod
    def of(cls, df: DataFrame, name: str, partition_key: list[str], clustering_key: list[str] | None = None, counters: set[str] | None = None) -> TableSpec:
        return cls(name, df.schema, tuple(partition_key), tuple(clustering_key or ()), frozenset(counters or ()))

    @property
    def key(self) -> tuple[str, ...]:
        return self.partition_key + self.clustering_key

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def type_of(self, column: str) -> T.DataType:
        return self.schema[column].dataType

    @property
    def values(self) -> list[str]:
        return [c for c in self.columns if c not in self.key]


@dataclass(frozen=True)
class Extract:
    """One JSON path of a text column into one target column."""

    column: str
    path: str
    target: str
    overwrite: bool = True
    exclusive: bool = False

    @classmethod
    def parse(cls, column: str, mapping: str, **options: bool) -> Extract:
        """``field:target``, a bare name, or a JSON pointer in place of the field."""
        path, _, target = mapping.partition(":")
        return cls(column, path, target or path.strip("/").split("/")[-1], **options)

    @property
    def json_path(self) -> str:
        parts = self.path.strip("/").split("/") if self.path.startswith("/") else [self.path]
        return "$" + "".join(f"[{p}]" if p.isdigit() else f"['{p.replace('~1', '/').replace('~0', '~')}']" for p in parts)


@dataclass(frozen=True)
class Explode:
    column: str
    key: str
    value: str


@dataclass
class JobSpec:
    """The options of a migrate, validate or guardrail job."""

    renames: list[tuple[str, str]] = field(default_factory=list)
    skip: list[str] = field(default_factory=list)
    constants: dict[str, str] = field(default_factory=dict)
    explode: Explode | None = None
    extract: Extract | None = None
    codecs: frozenset[str] = frozenset()
    timestamp_format: str | None = None
    timestamp_zone: str = "UTC"
    ttl_columns: list[str] | None = None
    writetime_columns: list[str] | None = None
    writetime_increment: int = 0
    custom_writetime: int = 0
    custom_ttl: int = 0
    collection_writetimes: bool = False
    where: str | None = None
    writetime_window: tuple[int, int] | None = None
    exclude_value: tuple[str, str] | None = None
    token_bounds: tuple[int, int] | None = None
    coverage: int = 100
    missing_key_timestamp_ms: int | None = None
    strip_null_map_values: bool = False
    parts: int = 8
    batch_size: int = 5
    fetch_size: int = 1000
    multiplier: int = 1
    guardrail_kb: float = 0.0
    guardrail_mode: str = "check"
    autocorrect_missing: bool = False
    autocorrect_mismatch: bool = False
    autocorrect_missing_counter: bool = False
    strict_empty: bool = False
    dry_run: bool = False
    batches: str = "strict"  # within partition keys, or "arrival": as rows arrive

    def canonical(self) -> str:
        """All options as one line of JSON, names in order; equal options give the same line."""
        return json.dumps(asdict(self), sort_keys=True, default=sorted)

    def config_hash(self) -> str:
        return hashlib.sha256(self.canonical().encode()).hexdigest()

    @staticmethod
    def parse_rename(text: str) -> tuple[str, str]:
        parts = text.split(":")
        if len(parts) != 2 or not all(p.strip() for p in parts):
            raise SpecError([Violation("rename", f"'{text}' is not origin:target")])
        return parts[0].strip(), parts[1].strip()

    @staticmethod
    def constants_of(names: str, values: str, separator: str = ",") -> dict[str, str]:
        import re

        left = [n.strip() for n in names.split(",")] if names.strip() else []
        right = [v.strip() for v in re.split(separator, values)] if values.strip() else []
        if len(left) != len(right):
            raise SpecError([Violation("constants", f"{len(left)} names but {len(right)} values")])
        return dict(zip(left, right, strict=True))

    def violations(self) -> list[Violation]:
        """What is wrong with the options by themselves."""
        found = []

        def unless(ok: bool, rule: str, message: str) -> None:
            if not ok:
                found.append(Violation(rule, message))

        for name in ("parts", "batch_size", "fetch_size", "multiplier"):
            unless(getattr(self, name) >= 1, name, "must be 1 or more")
        unless(1 <= self.coverage <= 100, "coverage", "must be from 1 to 100")
        unless(self.guardrail_kb >= 0, "guardrail", "must be 0 or more")
        unless(self.guardrail_mode in ("check", "warn", "block"), "guardrail", "mode must be check, warn or block")
        unless(self.batches in ("strict", "arrival"), "batches", "must be strict or arrival")
        if self.explode:
            unless(all((self.explode.column, self.explode.key, self.explode.value)), "explode", "needs the map column and both target names")
        if self.extract:
            unless(bool(self.extract.column and self.extract.path), "extract", "needs the column and the path")
        if self.writetime_window:
            low, high = self.writetime_window
            unless(low > 0 and high > 0 and high > low, "writetime window", "both ends must be positive, the upper one larger")
        for name in ("writetime_increment", "custom_writetime", "custom_ttl"):
            unless(getattr(self, name) >= 0, name, "must be 0 or more")
        if self.token_bounds:
            unless(self.token_bounds[0] <= self.token_bounds[1], "token bounds", "the lower end lies above the upper one")
        both = {"TIMESTAMP_STRING_MILLIS", "TIMESTAMP_STRING_FORMAT"}
        unless(not both <= self.codecs, "codecs", "only one of the timestamp codecs can be used")
        if "TIMESTAMP_STRING_FORMAT" in self.codecs:
            from tidemark.functions.convert import pattern_problem

            problem = pattern_problem(self.timestamp_format or "")
            unless(problem is None, "codecs", problem or "")
        return found

    def notices(self, target: TableSpec) -> list[Violation]:
        found = []
        if self.effective_batch(target) != self.batch_size:
            found.append(Violation("batch_size", "rows are written one at a time"))
        return found

    def effective_batch(self, target: TableSpec) -> int:
        return 1 if target.counters or self.writetime_window or self.batch_size < 1 else self.batch_size


def check_tables(origin: TableSpec, target: TableSpec, job: JobSpec) -> tuple[list[Violation], list[Violation]]:
    """What is wrong with the options given these tables, and what is worth a warning."""
    wrong, warn = [], []
    for o, t in job.renames:
        if o not in origin.columns:
            wrong.append(Violation("rename", f"the origin has no column {o}"))
        if t not in target.columns:
            wrong.append(Violation("rename", f"the target has no column {t}"))
    for c in job.skip:
        if c not in origin.columns:
            wrong.append(Violation("skip", f"the origin has no column {c}"))
        elif c in origin.key:
            wrong.append(Violation("skip", f"{c} is part of the key"))
    for c in job.constants:
        if c not in target.columns:
            wrong.append(Violation("constants", f"the target has no column {c}"))
    if job.explode:
        if job.explode.column not in origin.columns or not isinstance(origin.type_of(job.explode.column), T.MapType):
            wrong.append(Violation("explode", f"{job.explode.column} is not a map column of the origin"))
        wrong += [Violation("explode", f"the target has no column {c}") for c in (job.explode.key, job.explode.value) if c not in target.columns]
    if job.extract:
        if job.extract.column not in origin.columns or not isinstance(origin.type_of(job.extract.column), T.StringType):
            wrong.append(Violation("extract", f"{job.extract.column} is not a text column of the origin"))
        if job.extract.target not in target.columns:
            wrong.append(Violation("extract", f"the target has no column {job.extract.target}"))
    if job.exclude_value and (job.exclude_value[0] not in origin.columns or not isinstance(origin.type_of(job.exclude_value[0]), T.StringType)):
        wrong.append(Violation("column filter", f"{job.exclude_value[0]} is not a text column of the origin"))
    counters = bool(origin.counters or target.counters)
    if counters and (job.ttl_columns or job.writetime_columns or job.custom_ttl or job.custom_writetime):
        wrong.append(Violation("counters", "counter tables carry no TTL or writetime"))
    renamed = {o: t for o, t in job.renames}
    for c in origin.key:
        if renamed.get(c, c) not in target.key:
            warn.append(Violation("keys", f"origin key column {c} is no target key column; rows may share a target key"))
    for c in target.values:
        if isinstance(target.type_of(c), T.ArrayType) and not target.schema[c].metadata.get("frozen") and not target.schema[c].metadata.get("set"):
            warn.append(Violation("lists", f"{c} is an unfrozen list; repeated writes may repeat its elements"))
    return wrong, warn
