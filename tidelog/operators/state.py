"""Current state, history and fill of unchanged values, from committed changes.

Tables have a key, or rows are told apart by all of their values: where no column is flagged as key, or where replica
identity is full and all are. Equal rows of such a table are copies, and the state holds as many as there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelog.functions.scalars import get
from tidelog.operators.carry import along_keys, broadcast_if_few, dealt_by_key
from tidelog.sources.scratch import materialise

TABLE = ["slot", "schema", "table"]
BY = [*TABLE, "key"]
AT = ["commit_seq", "seq", "step"]
#: Truncated tables, one for each truncate that holds, up to which they are broadcast.
FEW_CUTS = 1_000_000
#: Keys whose last change left values out, up to which they are broadcast.
FEW_PARTIAL = 500_000
#: Changes of one key from which on they are ordered in segments, and commit places of a segment.
HOT, SEGMENT = 100_000, 1 << 13


def by_value() -> Column:
    """True for changes of tables whose rows are told apart by all of their values."""
    full = (F.col("replica_identity") == "full") & (F.size("primary_key") == F.size("column_names"))
    return (F.size("primary_key") == 0) | full


def _whole_new() -> Column:
    """The new row, with values that did not change taken from the old row where that is a full one."""
    filled = F.transform("old_row", lambda o: F.coalesce(F.get(F.filter("new_row", lambda n: n["name"] == o["name"]), F.lit(0)), o))
    partial = (F.col("key_type") == "O") & (F.size("new_row") < F.size("old_row"))
    return F.when(partial, filled).otherwise(F.col("new_row"))


def whole_changes(changes: DataFrame) -> DataFrame:
    """Inserts, updates and deletes with whole new rows where the log has them; a change that can't name its row fails the query."""
    rows = changes.where(F.col("tag").isin("I", "U", "D")).withColumn("new_row", _whole_new())
    lost = by_value() & (F.col("tag") != "I") & F.col("old_row").isNull()
    said = F.concat(F.lit("no key and no old row for a change of "), F.concat_ws(".", "schema", "table"))
    return rows.withColumn("old_row", F.when(lost, F.raise_error(said).cast(rows.schema["old_row"].dataType)).otherwise(F.col("old_row")))


def keyed(changes: DataFrame) -> DataFrame:
    """Adds key (the key's values in the relation's order, or all values) and live; a change of key is a removal of the old and an upsert of the new.

    Order is (commit_seq, seq, step): a removal comes before the upsert it belongs to.
    """
    rows = whole_changes(changes)
    names = F.when(by_value(), F.col("column_names")).otherwise(F.col("primary_key"))
    pick = lambda row: F.transform("_names", lambda n: F.get(F.filter(row, lambda c: c["name"] == n), F.lit(0))["value"])
    rows = rows.withColumn("_names", names).withColumns({"_old_key": pick("old_row"), "_new_key": pick("new_row")})
    moved = (F.col("tag") == "U") & F.col("old_row").isNotNull() & (F.col("_old_key") != F.col("_new_key"))
    gone = F.struct(F.lit(0).alias("step"), F.col("_old_key").alias("key"), F.lit(False).alias("live"))
    there = F.struct(F.lit(1).alias("step"), F.col("_new_key").alias("key"), F.lit(True).alias("live"))
    parts = F.when(F.col("tag") == "D", F.array(gone)).when(moved, F.array(gone, there)).otherwise(F.array(there))
    rows = rows.withColumn("_p", F.explode(parts))
    return rows.select("*", "_p.step", "_p.key", "_p.live").drop("_p", "_names", "_old_key", "_new_key")


def _position() -> Column:
    return F.struct(*AT)


def _cuts(changes: DataFrame) -> DataFrame:
    """(slot, _t, commit_seq, seq) of the truncates of each table."""
    rows = changes.where("tag = 'T'").select("slot", "commit_seq", "seq", F.explode("truncate_tables").alias("_t"))
    return rows


def _table_name() -> Column:
    return F.concat_ws(".", "schema", "table")


def after_truncates(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """Rows that no later committed truncate of their table wipes."""
    cuts = _cuts(changes).groupBy("slot", "_t").agg(F.max(F.struct("commit_seq", "seq")).alias("_cut"))
    rows = rows.withColumn("_t", _table_name()).join(broadcast_if_few(cuts, F.lit(1), FEW_CUTS), ["slot", "_t"], "left")
    return rows.where(F.col("_cut").isNull() | (F.struct("commit_seq", "seq") > F.col("_cut"))).drop("_t", "_cut")


def net_state(changes: DataFrame) -> DataFrame:
    """The rows that are there after all committed changes: slot, schema, table, key, row, commit_seq.

    With a key: one pass by key gives the last change of each; where its row is whole, as nearly all are, that is the
    row. Only for the other keys the columns are gone through: a column's value is then the last one sent for the key
    since it was last absent. (It is not looked for under an old key: a change of key has to send it.) Rows told apart
    by value are counted, inserts up and deletes down. All passes are pre-aggregated; no task holds the history of a key.
    """
    rows = after_truncates(changes.where(F.col("tag").isin("I", "U", "D")), changes)
    return _by_key(keyed(rows.where(~by_value()))).unionByName(_by_value(whole_changes(rows.where(by_value()))))


def _by_key(rows: DataFrame) -> DataFrame:
    fresh = F.max(F.when(~F.col("live") | (F.col("tag") == "I"), _position())).alias("_born")
    whole = F.size("new_row") >= F.size("column_names")
    last = F.max_by(F.struct("live", "commit_seq", whole.alias("whole"), F.when(whole, F.col("new_row")).alias("row")), _position())
    lives = materialise(rows.groupBy(*BY).agg(fresh, last.alias("_last")).where("_last.live"), "lives")
    done = lives.where("_last.whole").select(*BY, "_last.row", "_last.commit_seq")
    partial = lives.where("not _last.whole").select(*BY, "_born", F.col("_last.commit_seq").alias("_commit"))
    partial = broadcast_if_few(partial, F.lit(1), FEW_PARTIAL)
    values = rows.where("live").join(partial, BY).select(*BY, "_born", "_commit", _position().alias("_at"), F.posexplode("new_row").alias("_pos", "_c"))
    values = values.where(F.col("_born").isNull() | (F.col("_at") >= F.col("_born")))
    each = values.groupBy(*BY, F.col("_c.name").alias("name")).agg(
        F.max_by(F.struct("_c.kind", "_c.value"), "_at").alias("v"), F.min("_pos").alias("pos"), F.first("_commit").alias("commit_seq")
    )
    row = F.transform(
        F.sort_array(F.collect_list(F.struct("pos", "name", "v"))),
        lambda x: F.struct(x["name"].alias("name"), x["v"]["kind"].alias("kind"), x["v"]["value"].alias("value")),
    )
    return done.unionByName(each.groupBy(*BY).agg(row.alias("row"), F.first("commit_seq").alias("commit_seq")))


def _by_value(rows: DataFrame) -> DataFrame:
    side = lambda row, n: F.when(row.isNotNull(), F.struct(row.alias("row"), F.lit(n).cast("long").alias("n")))
    sides = F.array_compact(F.array(side(F.when(F.col("tag") != "I", F.col("old_row")), -1), side(F.when(F.col("tag") != "D", F.col("new_row")), 1)))
    counted = rows.select(*TABLE, "commit_seq", F.explode(sides).alias("x")).groupBy(*TABLE, F.col("x.row").alias("row"))
    left = counted.agg(F.sum("x.n").alias("n"), F.max("commit_seq").alias("commit_seq")).where("n > 0")
    key = F.transform("row", lambda c: c["value"]).alias("key")
    return left.select(*TABLE, key, "row", "commit_seq", F.explode(F.sequence(F.lit(1).cast("long"), "n"))).drop("col")


def latest(changes: DataFrame) -> DataFrame:
    """net_state() for logs whose rows have a key and are always whole: one pre-aggregated pass and nothing else."""
    rows = keyed(after_truncates(changes.where(F.col("tag").isin("I", "U", "D")), changes))
    last = F.max_by(F.struct("live", "new_row", "commit_seq"), _position())
    seen = rows.groupBy(*BY).agg(last.alias("x")).where("x.live")
    return seen.select(*BY, F.col("x.new_row").alias("row"), F.col("x.commit_seq").alias("commit_seq"))


def _cut_in_segments(rows: DataFrame) -> tuple[DataFrame, bool]:
    """Adds _segment: for keys with more than HOT changes the stretch of commits that a row lies in, null for others; and says if there are such."""
    hot = rows.groupBy(*BY).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > HOT).select(*BY, F.lit(True).alias("_hot"))
    hot = materialise(hot, "hot")
    if hot.isEmpty():
        return rows.withColumn("_segment", F.lit(None).cast("long")), False
    rows = rows.join(broadcast_if_few(hot, F.lit(1), FEW_CUTS), BY, "left")
    return rows.withColumn("_segment", F.when(F.col("_hot"), F.floor(F.col("commit_seq") / SEGMENT))).drop("_hot"), True


def _lives(changes: DataFrame, values: dict[str, Column] | None = None) -> tuple[DataFrame, bool]:
    """Keyed rows with _life, told apart by the last birth or removal of the key and the truncates before, and the next change and truncate.

    Also whether some keys are cut in segments. _next and _cut are places (commit_seq, seq). values are carried along a key: the last one that is not null.
    """
    cuts = _cuts(changes).groupBy("slot", "_t").agg(F.sort_array(F.collect_list(F.struct("commit_seq", "seq"))).alias("_cuts"))
    rows = keyed(changes).withColumn("_t", _table_name()).join(broadcast_if_few(cuts, F.size("_cuts"), FEW_CUTS), ["slot", "_t"], "left")
    here = F.struct("commit_seq", "seq")
    wiped = F.coalesce(F.size(F.filter("_cuts", lambda c: c < here)), F.lit(0))
    rows = rows.withColumns({"_wiped": wiped, "_cut": F.get(F.filter("_cuts", lambda c: c > here), F.lit(0))}).drop("_cuts", "_t")
    fresh = F.when(~(F.col("live") & (F.col("tag") != "I")), _position())
    known = {f"_last_{n}": F.when(v.isNotNull(), F.struct(_position().alias("at"), F.col("_wiped").alias("wiped"), v.alias("value"))) for n, v in (values or {}).items()}
    rows, cut = _cut_in_segments(rows)
    rows = dealt_by_key(rows, changes.count(), *BY, *(["_segment"] if cut else []))
    rows = along_keys(rows, BY, AT, {"_born": fresh} | known, {"_next": here}, cut)
    return rows.withColumn("_life", F.struct("_born", "_wiped")), cut


def toast_fill(changes: DataFrame, columns: list[str]) -> DataFrame:
    """Adds one value struct per column: the change's own, or the last one of its key since the key was last absent or its table truncated.

    The changes of a key are ordered in one task; where they are many, in segments, each of which starts from what the
    ones before come to.
    """
    rows, _ = _lives(changes, {c: F.when(F.col("live"), get(F.col("new_row"), c)) for c in columns})
    last = lambda c: F.col(f"_last_{c}")
    same = lambda c: (last(c)["wiped"] == F.col("_wiped")) & (F.col("_born").isNull() | (last(c)["at"] >= F.col("_born")))
    filled = [F.when(same(c), last(c)["value"]).alias(c) for c in columns]
    return rows.select(*[c for c in rows.columns if not c.startswith("_")], *filled)


def history(changes: DataFrame) -> DataFrame:
    """Versions of every key: row, valid_from and valid_to in commit_seq (null: current), without removals.

    A version ends with the next change of its key or with a truncate of its table. Unchanged values are filled as by
    toast_fill(). Rows told apart by value are keyed by all values; a repeat replaces the row before. The changes of a
    key with many are ordered in segments.
    """
    rows, cut = _lives(changes)
    end = F.when(F.col("_next").isNull() | (F.col("_cut") < F.col("_next")), F.col("_cut")).otherwise(F.col("_next"))
    rows = rows.withColumns({"valid_to": end["commit_seq"], "valid_from": F.col("commit_seq")}).where("live")
    rows = materialise(rows, "versions")
    partial = rows.where(F.size("new_row") < F.size("column_names")).select(*BY, "_life").distinct().withColumn("_partial", F.lit(True))
    rows = rows.join(broadcast_if_few(partial, F.lit(1), FEW_CUTS), [*BY, "_life"], "left")
    names = [*BY, "row", "valid_from", "valid_to"]
    whole = rows.where("_partial is null").withColumn("row", F.col("new_row")).select(names)
    cells = rows.where("_partial").select(*BY, "_life", "_segment", *AT, "valid_from", "valid_to", "new_row", F.posexplode("column_names").alias("_pos", "_name"))
    n = rows.where("_partial").agg(F.sum(F.size("column_names"))).first()[0] or 0
    # without segments all of a key's cells lie in one task, which orders them and puts the rows together again
    cells = dealt_by_key(cells, n, *BY, *(["_life", "_name", "_segment"] if cut else []))
    own = F.get(F.filter("new_row", lambda c: c["name"] == F.col("_name")), F.lit(0))
    cells = cells.withColumn("_own", own).drop("new_row")
    known = F.when(F.col("_own").isNotNull(), F.struct(_position().alias("at"), F.col("_own").alias("value")))
    cells = along_keys(cells, [*BY, "_life", "_name"], AT, {"_value": known}, cut=cut).withColumn("_value", F.col("_value.value")).where("_value is not null")
    listed = F.sort_array(F.collect_list(F.struct("_pos", "_value")))
    filled = cells.groupBy(*BY, "valid_from", "valid_to", *AT[1:]).agg(F.transform(listed, lambda x: x["_value"]).alias("row"))
    return whole.unionByName(filled.select(names))
