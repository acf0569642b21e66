"""Reader output and code payloads: JSON in prose, key-value strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tagloom.functions.numbers import price_text
from tagloom.functions.text import bound, digits_only, strip
from tagloom.schema import DOT_PRICES, FIELDS, PAYLOAD_KEYS

EXTRA = "_extra"


def json_in(raw: Column) -> Column:
    """map<string,string> of the object from the first ``{`` to the last ``}``; empty if there is none or it is broken."""
    found = F.from_json(F.regexp_extract(F.coalesce(raw, F.lit("")), r"(?s)\{.*\}", 0), "map<string,string>")
    return F.coalesce(found, F.from_json(F.lit("{}"), "map<string,string>"))


def field_of(m: Column, field: str) -> Column:
    """A stripped value of the map; missing and null are blank."""
    return strip(F.try_element_at(m, F.lit(field)))


def fields_of(m: Column, fields: list[str] | None = None) -> list[Column]:
    return [field_of(m, f).alias(f) for f in (fields or FIELDS)]


def nfkc(s: Column) -> Column:
    """Compatibility composition (NFKC) on the JVM, by the ICU library that Spark ships; ASCII text doesn't reach it."""
    composed = F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), s, F.lit(True))
    return F.when(s.rlike(r"[^\x00-\x7F]"), composed).otherwise(s)


def unquoted(s: Column) -> Column:
    """Percent escapes decoded; ``+`` and what isn't a valid escape stay."""
    guarded = F.regexp_replace(F.replace(s, F.lit("+"), F.lit("%2B")), "%(?![0-9A-Fa-f]{2})", "%25")
    return F.when(s.contains("%"), F.coalesce(F.try_url_decode(guarded), s)).otherwise(s)


def parse_payload(payload: Column, keys: dict[str, list[str]] | None = None, prices: list[str] | None = None) -> Column:
    """map<string,string> of a payload such as ``b=467...|p1=252.63``.

    The text is brought into NFKC form first, so full-width digits and signs
    are read as plain ones.  Twelve to fourteen digits alone are the code;
    pairs of known keys (any case) go to their fields, the last of a key wins;
    the rest is gathered under ``_extra``.
    """
    keys, prices = keys or PAYLOAD_KEYS, prices or DOT_PRICES
    alias = F.create_map(*[F.lit(x) for field, names in keys.items() for n in names for x in (n.lower(), field)])
    code = lambda v: F.create_map(F.lit("qr_code_barcode"), v)
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    pattern = r"(?s)^([A-Za-z][A-Za-z0-9]*)(?U:\s*)[=:](?U:\s*)(.+)\z"

    def pair(p: Column) -> Column:
        said = F.struct(F.try_element_at(alias, F.lower(F.regexp_extract(p, pattern, 1))).alias("field"), strip(F.regexp_extract(p, pattern, 2)).alias("value"))

        def read(m: Column) -> Column:
            field, value = m["field"], m["value"]
            plain = F.when(digits_only(value) != "", digits_only(value)).otherwise(value)
            known = F.when(field == "qr_code_barcode", plain).when(field.isin(prices), price_text(value)).otherwise(value)
            return F.struct(F.coalesce(field, F.lit(EXTRA)).alias("key"), F.when(field.isNull(), p).otherwise(known).alias("value"))

        return bound(said, read)

    def by_key(pairs: Column) -> Column:
        """The last value of each key, keys in the order of these; what has no key at the end."""
        names = F.transform(pairs, lambda e: e["key"])
        last = F.filter(pairs, lambda e, i: (e["key"] != EXTRA) & ~F.array_contains(F.slice(names, i + 2, F.size(names)), e["key"]))
        rest = F.transform(F.filter(pairs, lambda e: e["key"] == EXTRA), lambda e: e["value"])
        extra = F.filter(F.array(F.struct(F.lit(EXTRA).alias("key"), F.array_join(rest, " | ").alias("value"))), lambda e: F.size(rest) > 0)
        return F.map_from_entries(F.concat(last, extra))

    def parsed(raw: Column) -> Column:
        digits = digits_only(raw)
        unpaired = F.when(F.length(digits).between(12, 14), code(digits)).otherwise(F.create_map(F.lit(EXTRA), raw))
        pairs = F.transform(F.filter(F.transform(F.split(raw, r"[|&;\n]+"), strip), lambda p: p != ""), pair)
        return F.when(raw == "", empty).when(raw.rlike(r"^[0-9]{12,14}\z"), code(raw)).when(~raw.contains("=") & ~raw.contains(":"), unpaired).otherwise(bound(pairs, by_key))

    return bound(strip(unquoted(strip(nfkc(payload)))), parsed)


def chat_record(image: Column, prompt: str, fields: list[str] | None = None) -> Column:
    """Training record: image, question, and the fields of the row as the JSON answer."""
    answer = F.to_json(F.struct(*[F.coalesce(F.col(f), F.lit("")).alias(f) for f in (fields or FIELDS)]))
    message = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    return F.struct(image.alias("image"), F.array(message("user", F.lit(prompt)), message("assistant", answer)).alias("messages"))


def truth_of(record: Column) -> Column:
    """map<string,string> of a record's last message, whose content is text or a list of blocks with text."""
    last = F.get_json_object(record, "$.messages")
    items = F.from_json(last, "array<struct<role:string,content:string>>")
    content = F.element_at(items, -1)["content"]
    block = F.get_json_object(content, "$[0].text")
    return json_in(F.coalesce(block, content))
