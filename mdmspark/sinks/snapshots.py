"""Two-phase commit of a dated snapshot.

A run writes its attempt to a hidden folder, reads it back and compares content
fingerprints; only then does one switch put it in the place of the date's
snapshot. A failed run leaves the old snapshot as it was.

The switch is two renames: the old folder to ``_replaced/<date>``, the attempt to
the date's folder. Each rename is one step; a crash leaves one of these states,
and :func:`recover_snapshot` (called before each commit) settles it:

================================  ===========================================
state                             rule
================================  ===========================================
an attempt, no ``_replaced``      the switch had not begun: the attempt goes
``_replaced``, no date folder     between the renames: the attempt, verified
                                  (it has its manifest), takes the place; if it
                                  is gone, the old snapshot comes back
``_replaced`` and a date folder   the switch was done: ``_replaced`` goes
================================  ===========================================

One writer per table and date at a time. A reader that comes between the two
renames finds no snapshot of the date (an error, never wrong rows).
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession

from mdmspark.operators.fingerprint import Fingerprint, check_aggregates, fingerprint, from_metrics
from mdmspark.session import spread
from mdmspark.sinks.files import shape_files
from mdmspark.sources.files import SNAPSHOT_COLUMN, parse_snapshot_date, snapshot_path
from mdmspark.sources.manifest import MANIFEST, Manifest, Store, check_files, read_manifest

ATTEMPTS, REPLACED = "_attempts", "_replaced"


class ReconcileError(RuntimeError):
    """The rows read back differ from the rows written, or from the caller's control totals."""


def _hidden(root: str, kind: str, d: dt.date) -> str:
    return f"{root.rstrip('/')}/{kind}/{d.isoformat()}"


def recover_snapshot(spark: SparkSession, root: str, snapshot_date: str | dt.date) -> str:
    """Settle what an interrupted commit of the date left; what was done:
    ``clean``, ``dropped`` (an attempt), ``finished``, ``restored`` or ``tidied``."""
    d = parse_snapshot_date(snapshot_date)
    store, home = Store(spark, root), snapshot_path(root, d)
    attempts, replaced = _hidden(root, ATTEMPTS, d), _hidden(root, REPLACED, d)
    done = "clean"
    if store.exists(replaced) and not store.exists(home):
        verified = [a for n in store.names(attempts) if read_manifest(store, a := f"{attempts}/{n}")]
        done = "finished" if verified else "restored"
        store.move(verified[0] if verified else replaced, home)
    elif store.exists(replaced):
        done = "tidied"
    elif store.exists(attempts):
        done = "dropped"
    for path in (replaced, attempts):
        if store.exists(path):
            store.delete(path)
    return done


def _switch(store: Store, attempt: str, home: str, replaced: str) -> None:
    if store.exists(home):
        store.make_folder(replaced.rsplit("/", 1)[0])
        store.move(home, replaced)
    store.move(attempt, home)


def commit_snapshot(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    snapshot_date: str | dt.date,
    files: int | None = None,
    control: Fingerprint | None = None,
) -> Manifest:
    """Write ``df`` as the ``snapshot_date`` snapshot under ``root``, replacing
    the date's old one only after the written content has been read back and
    found equal. ``df`` is evaluated once: the sums that tell this are observed
    while it is written. Unless ``files`` is given, a source of few files is dealt
    to all tasks. ``control`` holds the source's own totals, if it gives any (its
    columns may be a part of the table's; their sums must be equal).

    Raises :class:`ReconcileError` with the old snapshot unchanged."""
    d = parse_snapshot_date(snapshot_date)
    recover_snapshot(spark, root, d)
    store, home = Store(spark, root), snapshot_path(root, d)
    attempt = f"{_hidden(root, ATTEMPTS, d)}/{uuid.uuid4().hex}"
    rows = df.drop(SNAPSHOT_COLUMN)
    observed = Observation(f"commit_{uuid.uuid4().hex}")
    try:
        shaped = spread(rows) if files is None else shape_files(rows, files)
        shaped.observe(observed, *check_aggregates(rows)).write.parquet(attempt)
        written = from_metrics(observed.get, rows.columns)
        found = fingerprint(spark.read.schema(rows.schema).parquet(attempt))
        faults = [f"read back: {x}" for x in written.differences(found.checked())]
        if control is not None:
            held = Fingerprint(found.rows, {c: v for c, v in found.parts.items() if c in control.parts})
            faults += [f"control totals: {x}" for x in control.differences(held)]
        if faults:
            raise ReconcileError(f"{home}: " + "; ".join(faults))
        manifest = Manifest(found, rows.schema, store.files(attempt))
        store.write(f"{attempt}/{MANIFEST}", manifest.to_json())
    except BaseException:
        store.delete(attempt)
        raise
    _switch(store, attempt, home, _hidden(root, REPLACED, d))
    check_files(store, home, manifest)
    recover_snapshot(spark, root, d)  # the switch is done: the old snapshot goes
    return manifest
