"""Column functions: parsing, encodings and display text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from acctpulse import schema

# Timestamp texts seen in batch files, most specific first.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "yyyy-MM-dd",
)


def parse_mixed_ts(text: Column) -> Column:
    """Timestamp from text of any accepted precision; null where nothing parses.

    The plain cast covers ISO texts with zone suffixes and odd fraction lengths.
    """
    parsed = [F.try_to_timestamp(text, F.lit(f)) for f in TIMESTAMP_FORMATS]
    return F.coalesce(*parsed, text.try_cast("timestamp"))


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def epoch_seconds(ts: Column) -> Column:
    return epoch_micros(ts) / F.lit(1_000_000.0)


def text_key(col: Column) -> Column:
    """Missing text compares as the literal ``nan``, equal to itself."""
    return F.coalesce(col.cast("string"), F.lit("nan"))


def dc_sign(code: Column) -> Column:
    """Debit +1, credit -1, anything else 0."""
    return F.when(code == "D", 1).when(code == "C", -1).otherwise(0)


def encode(col: Column, codes: Mapping[str, int] | None, default: Mapping[str, int]) -> Column:
    """Category to integer, -1 when unknown; an empty map means the default map."""
    table = dict(codes or default)
    pairs = [F.lit(x) for item in table.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col), F.lit(-1))


def descr_encoded(col: Column, codes: Mapping[str, int] | None = None) -> Column:
    return encode(text_key(col), codes, schema.DESCR_CODES)


def input_source_encoded(col: Column, codes: Mapping[str, int] | None = None) -> Column:
    return encode(text_key(col), codes, schema.INPUT_SOURCE_CODES)


def debit_credit_encoded(sign: Column, codes: Mapping[str, int] | None = None) -> Column:
    """The code is rebuilt from the sign, so an unknown code counts as a credit."""
    return encode(F.when(sign == 1, "D").otherwise("C"), codes, schema.DEBIT_CREDIT_CODES)


def hour_of_day(ts: Column) -> Column:
    return F.hour(ts)


def is_business_hours(ts: Column) -> Column:
    """Monday to Friday, 08:00 up to but not including 18:00."""
    open_hours = (F.weekday(ts) < 5) & (F.hour(ts) >= 8) & (F.hour(ts) < 18)
    return F.when(open_hours, 1).otherwise(0)


def finite_or_zero(col: Column, infinities: bool = False) -> Column:
    """Null and NaN become 0; with ``infinities`` also +-inf (the training rule)."""
    value = col.cast("double")
    if infinities:  # NaN is above all numbers; a short condition keeps tables of many columns in compiled code
        return F.when(F.abs(value) < F.lit(float("inf")), value).otherwise(F.lit(0.0))
    return F.coalesce(F.nanvl(value, F.lit(0.0)), F.lit(0.0))


def mask_account(account: Column, keep: int = 4) -> Column:
    return F.concat(F.lit("..."), F.right(account, F.lit(keep)))


def clock_text(ts: Column) -> Column:
    return F.date_format(ts, "HH:mm:ss")


def format_amount(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, 2))


def format_score(score: Column) -> Column:
    return F.format_string("%+.4f", score)


def text_guard(col: Column) -> Column:
    """``="..."`` keeps a spreadsheet from turning a long key into a number."""
    return F.concat(F.lit('="'), col, F.lit('"'))


def label_to_flag(label: Column) -> Column:
    return label == -1


def channel_label(code: Column) -> Column:
    pairs = [F.lit(x) for item in schema.CHANNEL_LABELS.items() for x in item]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), code)


def feature_description(name: Column) -> Column:
    """Reader-facing text of a feature; unknown names are title-cased."""
    from acctpulse.functions.labels import FEATURE_DESCRIPTIONS

    pairs = [F.lit(x) for item in FEATURE_DESCRIPTIONS.items() for x in item]
    described = F.try_element_at(F.create_map(*pairs), name)
    return F.coalesce(described, F.initcap(F.replace(name, F.lit("_"), F.lit(" "))))


def result_json(*cols: Column | str) -> Column:
    return F.to_json(F.struct(*cols))
