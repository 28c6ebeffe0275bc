"""Operators over listings of files and run folders: rows are files, contents are never touched."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..session import materialise

IMAGE_EXTENSIONS = ("jpg", "png", "jpeg")


def path_parts(df: DataFrame, path_col: str = "path", directory: str = "out") -> DataFrame:
    path = F.col(path_col)
    return df.withColumns({"name": S.file_name(path), "stem": S.stem(path), "ext": S.extension(path), "moved": S.moved_to(path, directory)})


def by_extension(df: DataFrame, extensions: Sequence[str], path_col: str = "path") -> DataFrame:
    """Files with one of the suffixes; case counts."""
    return df.where(S.extension(F.col(path_col)).isin(*extensions))


def ext_rank(extensions: Sequence[str] = IMAGE_EXTENSIONS, path_col: str = "path") -> Column:
    return F.array_position(F.array(*[F.lit(e) for e in extensions]), S.extension(F.col(path_col))).cast("int")


def extension_major(df: DataFrame, extensions: Sequence[str] = IMAGE_EXTENSIONS, path_col: str = "path") -> DataFrame:
    """One listing per suffix, in the order given, each sorted by path; ``ext_rank`` tells which."""
    return by_extension(df, extensions, path_col).withColumn("ext_rank", ext_rank(extensions, path_col)).orderBy("ext_rank", path_col)


def union_listings(df: DataFrame, extensions: Sequence[str] = IMAGE_EXTENSIONS, path_col: str = "path") -> DataFrame:
    """The listings of several suffixes one after the other, duplicates kept."""
    out = None
    for e in extensions:
        part = by_extension(df, [e], path_col)
        out = part if out is None else out.unionByName(part)
    return out


def indexed(df: DataFrame, *order: str | Column, into: str = "idx") -> DataFrame:
    """Dense position (from 0) in a total order, without moving all rows to one task.

    Rows are range-partitioned and sorted once into shared storage; each partition's count, a number per partition, gives
    its offset."""
    part, local = F.shiftright("_m", 33), F.col("_m").bitwiseAND(F.lit((1 << 33) - 1))
    rows = materialise(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()), "sorted")
    counts = rows.groupBy(part.alias("_p")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_p", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_o"))
    return rows.join(F.broadcast(offsets), part == F.col("_p")).withColumn(into, F.col("_o") + local).drop("_m", "_p", "_o")


def pair_positional(images: DataFrame, masks: DataFrame, image_order: Sequence[str | Column], mask_order: Sequence[str | Column], path_col: str = "path") -> DataFrame:
    """(idx, image_path, mask_path): the n-th image with the n-th mask, whatever their names; the longer tail is left out."""
    a = indexed(images, *image_order).select("idx", F.col(path_col).alias("image_path"))
    b = indexed(masks, *mask_order).select("idx", F.col(path_col).alias("mask_path"))
    return a.join(b, "idx")


def pair_by_stem(images: DataFrame, masks: DataFrame, path_col: str = "path") -> DataFrame:
    """(stem, image_path, mask_path): files of equal stem."""
    a = images.select(S.stem(F.col(path_col)).alias("stem"), F.col(path_col).alias("image_path"))
    b = masks.select(S.stem(F.col(path_col)).alias("stem"), F.col(path_col).alias("mask_path"))
    return a.join(b, "stem")


def pair_count_guard(images: DataFrame, masks: DataFrame) -> DataFrame:
    """One row: both counts, whether pairing may go on, and the reason if not."""
    a = images.agg(F.count("*").alias("n_images"), F.lit(0).cast("long").alias("n_masks"))
    b = masks.agg(F.lit(0).cast("long").alias("n_images"), F.count("*").alias("n_masks"))
    both = a.unionByName(b).agg(F.sum("n_images").alias("n_images"), F.sum("n_masks").alias("n_masks"))
    equal = F.col("n_images") == F.col("n_masks")
    return both.select("n_images", "n_masks", equal.alias("ok"), F.when(~equal, "unequal_counts").otherwise("").alias("reason"))


def guarded_pairs(images: DataFrame, masks: DataFrame, image_order: Sequence[str | Column], mask_order: Sequence[str | Column]) -> tuple[DataFrame, DataFrame]:
    """(pairs, guard row); no pairs if the counts differ."""
    guard = pair_count_guard(images, masks)
    pairs = pair_positional(images, masks, image_order, mask_order)
    return (pairs if guard.first().ok else pairs.limit(0)), guard


def unpaired_files(images: DataFrame, masks: DataFrame, path_col: str = "path") -> DataFrame:
    """(side, path) of files whose stem the other side lacks."""
    a = images.select(F.lit("image").alias("side"), F.col(path_col).alias("path"), S.stem(F.col(path_col)).alias("stem"))
    b = masks.select(F.lit("mask").alias("side"), F.col(path_col).alias("path"), S.stem(F.col(path_col)).alias("stem"))
    return a.join(b, "stem", "left_anti").unionByName(b.join(a, "stem", "left_anti")).select("side", "path")


def split_exact(df: DataFrame, id_col: str = "image_id", share: float = 0.8, seed: int = 42) -> DataFrame:
    """``subset``: exactly floor(share * n) rows are train, the rest val, by a seeded permutation; also its ``rank``."""
    ranked = indexed(df.withColumn("_k", F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))), "_k", id_col, into="rank").drop("_k")
    n = df.count()
    return ranked.withColumn("subset", F.when(F.col("rank") < int(share * n + 1e-9), "train").otherwise("val"))


def batch_assign(df: DataFrame, batch_size: int, id_col: str = "image_id", epoch: int | None = None) -> DataFrame:
    """``batch_id``: rows in order of id, or shuffled by epoch; the last batch may be short."""
    if epoch is None:
        ranked = indexed(df, id_col, into="_r")
    else:
        ranked = indexed(df.withColumn("_k", F.md5(F.concat(F.lit(f"{epoch}:"), F.col(id_col).cast("string")))), "_k", id_col, into="_r").drop("_k")
    return ranked.withColumn("batch_id", F.floor(F.col("_r") / batch_size).cast("long")).drop("_r")


def scan_runs(folders: DataFrame, folder_col: str = "folder") -> DataFrame:
    """(folder, run_date) of the names ``<type>_<date>``; others are left out."""
    return all_runs(folders, folder_col).where("run_date is not null")


def all_runs(folders: DataFrame, folder_col: str = "folder") -> DataFrame:
    """(folder, run_date), the date null where the name has no second part or that is no date."""
    second = F.get(F.split(F.col(folder_col), "_"), F.lit(1))
    date = F.when(second.rlike("^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$"), F.try_to_timestamp(second, F.lit("y-M-d"))).cast("date")
    return folders.select(F.col(folder_col).alias("folder"), date.alias("run_date"))


def floor_days(date: Column, now: Column) -> Column:
    """Absolute value of the floored day difference: 1 for today's midnight, 0 for tomorrow's."""
    return F.abs(F.floor((F.unix_timestamp(date.cast("timestamp")) - F.unix_timestamp(now)) / 86400)).cast("long")


def latest_run(folders: DataFrame, now: str, folder_col: str = "folder") -> DataFrame:
    """One row (folder, diff): the run nearest in floored days; ties go to the smallest name."""
    runs = scan_runs(folders, folder_col).withColumn("diff", floor_days(F.col("run_date"), F.to_timestamp(F.lit(now))))
    return runs.agg(F.min_by("folder", F.struct("diff", "folder")).alias("folder"), F.min("diff").alias("diff"))


def last_and_next(df: DataFrame, order: Sequence[str | Column], value: Column) -> DataFrame:
    """``df`` with ``last`` and ``next``: the nearest value that isn't null, at or before a row and at or behind it in a total order.

    Rows are range-partitioned and sorted once into shared storage. Each partition looks at its own rows; what it hands on to the
    others is its first and last value, two for a partition, which the driver carries over those that have none."""
    rows = materialise(df.withColumn("_v", value).orderBy(*order).withColumn("_m", F.monotonically_increasing_id()), "sorted")
    rows = rows.withColumn("_p", F.shiftright("_m", 33))
    some = rows.where("_v IS NOT NULL").groupBy("_p").agg(F.min_by("_v", "_m").alias("first"), F.max_by("_v", "_m").alias("last"))
    ends = {r["_p"]: r for r in some.collect()}
    parts = sorted(r[0] for r in rows.select("_p").distinct().collect())
    before, behind, carry = {}, {}, None
    for p in parts:
        before[p] = carry
        carry = ends[p]["last"] if p in ends else carry
    carry = None
    for p in reversed(parts):
        behind[p] = carry
        carry = ends[p]["first"] if p in ends else carry
    kind = dict(rows.dtypes)["_v"]
    handed = rows.sparkSession.createDataFrame([(p, before[p], behind[p]) for p in parts], f"_p long, _before {kind}, _behind {kind}")
    own = Window.partitionBy("_p").orderBy("_m")
    last = F.last("_v", True).over(own.rowsBetween(Window.unboundedPreceding, 0))
    following = F.first("_v", True).over(own.rowsBetween(0, Window.unboundedFollowing))
    seen = rows.withColumns({"last": last, "next": following}).join(F.broadcast(handed), "_p")
    return seen.withColumns({"last": F.coalesce("last", "_before"), "next": F.coalesce("next", "_behind")}).drop("_p", "_m", "_v", "_before", "_behind")


def nearest_run(requests: DataFrame, folders: DataFrame, at_col: str = "ts") -> DataFrame:
    """(at_col, folder, diff) for each distinct time asked for: the run nearest by floored days, ties to the smallest name.

    Floored days count from the first midnight not before the request, so requests reduce to days; days and run dates are
    one row per day of history, merged in one sorted pass over all partitions (an as-of look back and ahead) instead of being compared in pairs."""
    midnight = F.date_trunc("day", F.col(at_col))
    day = F.when(F.col(at_col) == midnight, midnight.cast("date")).otherwise(F.date_add(midnight.cast("date"), 1))
    asked = requests.select(F.col(at_col)).distinct().withColumn("day", day)
    runs = scan_runs(folders).groupBy(F.col("run_date").alias("day")).agg(F.min("folder").alias("name"))
    days = asked.select("day").distinct().withColumn("name", F.lit(None).cast("string")).unionByName(runs)
    seen = last_and_next(days, ["day", F.col("name").isNull()], F.when(F.col("name").isNotNull(), F.struct("day", "name")))
    both = seen.select("day", "name", *[F.col(c)[f].alias(a) for c, f, a in (("last", "day", "ba"), ("last", "name", "bn"), ("next", "day", "aa"), ("next", "name", "an"))])
    gap_b, gap_a = F.datediff("day", "ba"), F.datediff("aa", "day")
    take_b = F.col("aa").isNull() | F.coalesce(gap_b == 0, F.lit(False)) | (gap_b < gap_a) | ((gap_b == gap_a) & (F.col("bn") <= F.col("an")))
    best = both.where("name is null").select("day", F.when(take_b, F.col("bn")).otherwise(F.col("an")).alias("folder"), F.when(take_b, gap_b).otherwise(gap_a).cast("long").alias("diff"))
    return asked.join(best, "day").select(at_col, "folder", "diff")


def frame_count(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("n"))


def dataset_summary(split: DataFrame, learning_rate: float, batch_size: int, epochs: int) -> DataFrame:
    """One row: parameters and the sizes of both subsets."""
    return split.agg(F.lit(learning_rate).alias("learning_rate"), F.lit(batch_size).alias("batch_size"), F.lit(epochs).alias("epochs"), F.count_if(F.col("subset") == "train").alias("train_size"), F.count_if(F.col("subset") == "val").alias("val_size"))
