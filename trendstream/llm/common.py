"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space: space and \t \n \v \f \r.
WHITE = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def one_space(c: Column) -> Column:
    """Every run of ASCII white space becomes one space; null counts as empty."""
    return F.regexp_replace(text_or_empty(c), WHITE, " ")


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def free_name(name: str, taken: list[str]) -> str:
    """``name``, lengthened until no column of ``taken`` has it (in any case)."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def held_out(id_col: Column, folds: int = 5) -> Column:
    """crc32 of the id written as text, modulo ``folds``, is 0 (null id: as empty text)."""
    return F.crc32(text_or_empty(id_col).cast("binary")) % folds == 0


def unpack(df: DataFrame, row: str, added: list[str]) -> DataFrame:
    """The fields of struct ``row`` followed by ``added``; an added column replaces a field of its name."""
    taken = {a.lower() for a in added}
    fields = [f.name for f in df.schema[row].dataType.fields if f.name.lower() not in taken]
    return df.select(*[F.col(row)[f].alias(f) for f in fields], *[F.col(a) for a in added])


def hash_below(h: Column, most: int, total: Column | int) -> Column:
    """Holds for about 4 * ``most`` of ``total`` rows, those with the smallest hash ``h`` (all, if there are fewer).

    Taken before "the ``most`` rows with the smallest hash" it leaves their choice
    as it is and keeps what one task or the driver has to order bounded.
    """
    share = F.least(F.lit(1.0), F.lit(4.0 * most) / F.greatest(F.lit(1), total if isinstance(total, Column) else F.lit(total)))
    return h.cast("double") <= F.lit(-2.0 ** 63) + share * F.lit(2.0 ** 64)
