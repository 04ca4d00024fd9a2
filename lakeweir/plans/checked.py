"""Checks kept up with a table: what a commit changes is measured, not the whole table again.

Below ``root``, in a folder of its own for each set of checks, lie the counts of the last check and
the multiplicities of unique values, both tagged with the version of the table they describe. The
multiplicities are a keyed table, so a check writes those that changed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession

from lakeweir.operators import partial_checks as partial
from lakeweir.operators.quality import Check
from lakeweir.plans.tables import Table
from lakeweir.sources.scratch import staged

_TAG = "of-"


def tag_of(version: int) -> str:
    """Token of a commit that was made from ``version`` of another table."""
    return f"{_TAG}{version:08d}"


def made_from(table: Table) -> int | None:
    """The version of the other table that the newest commit of ``table`` was made from."""
    newest = table.newest()
    token = newest.token if newest else None
    return int(token.removeprefix(_TAG)) if token and token.startswith(_TAG) else None


@dataclass(frozen=True)
class CheckedTable:
    """Checks over ``table`` whose partial results are kept below ``root``."""

    table: Table
    root: str
    checks: tuple[Check, ...]

    @property
    def spark(self) -> SparkSession:
        return self.table.spark

    @property
    def folder(self) -> str:
        measured = sorted({repr(c) for check in self.checks for c in check.constraints})
        return f"{self.root.rstrip('/')}/{sha256(repr(measured).encode()).hexdigest()[:16]}"

    @property
    def counts(self) -> Table:
        return Table(self.spark, f"{self.folder}/counts")

    @property
    def multiplicities(self) -> Table:
        return Table(
            self.spark,
            f"{self.folder}/multiplicities",
            partial.MULTIPLICITIES,
            partial.KEYS,
        )

    def report(self) -> DataFrame:
        """The report on the table as it is now, from its changes since the last one."""
        version = self.table.newest().version
        if made_from(self.counts) != version:
            self._measure(version)
        counts = self.counts.read_snapshot()
        return partial.report_of(counts, self.checks, self.table.schema)

    def _measure(self, version: int) -> None:
        before = made_from(self.counts)
        changes = None
        # multiplicities that are ahead of the counts come from a check that broke off
        if before is not None and not self.multiplicities.has_token(tag_of(version)):
            changes = self.table.changed_since(before)
        if changes is None:
            self._measure_all(version)
        else:
            self._measure_changes(version, *changes)

    def _measure_all(self, version: int) -> None:
        rows = self.table.read_snapshot()
        self.multiplicities.write_snapshot(
            partial.multiplicities_of(rows, self.checks), tag_of(version)
        )
        singles = partial.single_values(self.multiplicities.read_snapshot())
        counts = partial.merged_counts(partial.counts_of(rows, self.checks), singles)
        self.counts.overwrite(counts, token=tag_of(version))

    def _measure_changes(self, version: int, came: DataFrame, left: DataFrame) -> None:
        columns = _measured(self.checks, came.columns)
        with (
            staged(came.select(*columns), "came") as plus,
            staged(left.select(*columns), "left") as minus,
        ):
            delta = partial.merged_multiplicities(
                partial.multiplicities_of(plus, self.checks),
                partial.multiplicities_of(minus, self.checks, -1),
            )
            held = self.multiplicities.read_snapshot()
            with staged(partial.changed_multiplicities(held, delta), "multiplicities") as changed:
                counts = partial.merged_counts(
                    self.counts.read_snapshot(),
                    partial.counts_of(plus, self.checks),
                    partial.counts_of(minus, self.checks, -1),
                    partial.single_changes(changed),
                )
                with staged(counts, "counts") as kept:
                    self.multiplicities.upsert(
                        changed.select(*partial.MULTIPLICITIES.names), tag_of(version)
                    )
                    self.counts.overwrite(kept, token=tag_of(version))


def _measured(checks: Sequence[Check], columns: Sequence[str]) -> list[str]:
    used = {c.column for check in checks for c in check.constraints}
    return [name for name in columns if name in used]
