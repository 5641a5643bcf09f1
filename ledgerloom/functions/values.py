"""Column expressions over values; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def match_key(name: Column) -> Column:
    """Form in which names are compared: no blanks (U+0020) around, upper case, accents kept."""
    return F.upper(F.trim(name))


def padded_key(key: Column, width: int = 8) -> Column:
    """Registration number as text, with the leading zeros a numeric reading loses; blank is null.

    A column of fractions is refused: 655522.0 is no registration number.
    """
    text = F.nullif(F.trim(key.cast("string")), F.lit(""))
    padded = F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
    kind = F.typeof(key)
    refused = F.raise_error(F.concat(F.lit("a registration number cannot be of type "), kind)).cast("string")
    return F.when(kind.rlike(r"^(float|double|decimal\(\d+,[1-9])"), refused).otherwise(padded)


# Fixed form: groups of three after points, or none, and decimals after a comma.
_COMMA_DECIMAL = r"^-?(\d{1,3}(\.\d{3})+|\d+)(,\d+)?$"
_NO_DECIMAL = " (no decimal with a comma)"


def plain_number(text: Column) -> Column:
    """``1.234,56`` as ``1234.56``; any other text comes out with a remark, so that no cast takes it.

    A point is only taken between groups of three digits: ``1.5`` is no number here, and ``1.234``
    is one thousand two hundred and thirty-four.
    """
    trimmed = F.trim(text)
    plain = F.replace(F.replace(trimmed, F.lit("."), F.lit("")), F.lit(","), F.lit("."))
    return F.when(trimmed.rlike(_COMMA_DECIMAL), plain).otherwise(F.concat(text, F.lit(_NO_DECIMAL)))


def decimal_comma(text: Column, precision: int = 10, scale: int = 2) -> Column:
    """``1.234,56`` as a decimal; null where the text is no such number."""
    return plain_number(text).try_cast(f"decimal({precision},{scale})")


def separator_of_path(path: Column) -> Column:
    """Separator of a delimited file, told by its path."""
    lowered = F.lower(path)
    return (
        F.when(lowered.endswith(".tsv"), "\t")
        .when(path.contains("|") | lowered.contains("glassdoor"), "|")
        .otherwise(",")
    )


#: Separators that a content may tell, the preferred one first.
SEPARATORS = (",", ";", "\t", "|")


def separator_of_header(line: Column) -> Column:
    """Separator that occurs most often in a header line; comma wins a draw."""
    counted = [
        F.struct(F.regexp_count(line, F.lit(pattern)).alias("n"), F.lit(-rank).alias("rank"), F.lit(sep).alias("sep"))
        for rank, (sep, pattern) in enumerate(zip(SEPARATORS, [",", ";", "\t", "[|]"]))
    ]
    return F.array_max(F.array(*counted))["sep"]


def separator_of_lines(lines: Column) -> Column:
    """Separator of the first lines of a file, an array: that which gives all of them as many fields.

    What stands in quotes does not count, over line breaks too, and neither does a line that is cut
    off within quotes. The separator with which most lines have as many fields as the first one wins,
    then that of more fields; comma wins a draw, and where no separator is in the first line.
    """
    text = F.array_join(lines, "\n")
    # Doubled quotes close and open again, so they need no rule of their own.
    unquoted = F.regexp_replace(text, '"[^"]*"', "")
    split = F.split(F.substring_index(unquoted, '"', 1), "\r?\n")
    cut_off = F.contains(unquoted, F.lit('"')) & (F.size(split) > 1)
    rows = F.filter(F.when(cut_off, F.slice(split, 1, F.size(split) - 1)).otherwise(split), lambda row: F.trim(row) != "")

    def vote(held: Column, rank: int, sep: str) -> Column:
        counts = F.transform(held, lambda row: F.length(row) - F.length(F.replace(row, F.lit(sep), F.lit(""))))
        agreeing = F.transform(
            F.array(counts),
            lambda own: F.struct(
                (F.get(own, F.lit(0)) > 0).alias("found"),
                F.size(F.filter(own, lambda n: n == F.get(own, F.lit(0)))).alias("agreeing"),
                F.get(own, F.lit(0)).alias("fields"),
                F.lit(-rank).alias("rank"),
                F.lit(sep).alias("sep"),
            ),
        )
        return F.get(agreeing, F.lit(0))

    votes = F.transform(F.array(rows), lambda held: F.array_max(F.array(*[vote(held, i, sep) for i, sep in enumerate(SEPARATORS)])))
    won = F.get(votes, F.lit(0))
    return F.when(won["found"], won["sep"]).otherwise(SEPARATORS[0])
