"""Deterministic ids. A null part counts as empty text, so no part ever drops out of a hash."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import GOLD_VERSION


def joined(*parts: Column | str) -> Column:
    columns = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.concat_ws("|", *columns)


def sha256(*parts: Column | str) -> Column:
    return F.sha2(joined(*parts), 256)


def iso_utc(t: Column | str) -> Column:
    """ISO-8601 with +00:00 and microseconds only where there are some (the session's zone is UTC)."""
    t = F.col(t) if isinstance(t, str) else t
    whole = F.date_trunc("second", t) == t
    return F.when(whole, F.date_format(t, "yyyy-MM-dd'T'HH:mm:ssxxx")).otherwise(F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"))


def event_id(source: Column | str, source_key: Column | str, event_time: Column | str) -> Column:
    return sha256(source, source_key, iso_utc(event_time))


def signal_id(shock: Column | str = "shock_id", price: Column | str = "price_event_id", version: str = GOLD_VERSION) -> Column:
    """Null where a part is missing or empty."""
    shock, price = (F.col(x) if isinstance(x, str) else x for x in (shock, price))
    return F.when((F.length(shock) > 0) & (F.length(price) > 0) & F.lit(bool(version)), sha256(shock, price, F.lit(version)))


def dead_letter_id(topic: Column | str, partition: Column | str, offset: Column | str, raw: Column | str) -> Column:
    return F.concat(F.lit("dlq:"), sha256(topic, partition, offset, raw))


def commodity_id(commodity: Column | str) -> Column:
    return F.sha2(F.upper(F.trim(commodity)), 256)


def lineage(ids: Column | str) -> Column:
    """Aggregate: hash of a group's ids in order."""
    return F.sha2(F.array_join(F.array_sort(F.collect_list(ids)), "|"), 256)


def canonical_json(c: Column | str) -> Column:
    """The same text for equal JSON: keys sorted at every depth, no spaces, numbers in their shortest form (a number with an exponent
    keeps a decimal point). Text that isn't JSON, or has a key twice, stays as it is."""
    text = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.to_json(F.try_parse_json(text)), text)


def rejected_id(source: Column | str, raw_json: Column | str) -> Column:
    """Id of a source record that became no event: the same for the same content, however its text is spaced and ordered."""
    return F.concat(F.lit("rejected:"), F.sha2(F.concat(F.col(source) if isinstance(source, str) else source, canonical_json(raw_json)), 256))


def place_key(c: Column | str) -> Column:
    """How names of places are compared."""
    return F.upper(F.trim(c))
