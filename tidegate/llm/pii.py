"""Personal data by anchor expansion.

An Aho-Corasick automaton walks each text once and reports anchors: at-signs, scheme
marks, digits and identifier cues. Deterministic local parsers then expand an anchor to
the left and right, and validators keep or drop what they found:

* ``email``: the local part before an at-sign and a domain of two labels or more after it;
* ``ip``: four groups of digits, each at most 255;
* ``card``: 12 to 19 digits, single blanks or hyphens between, with a right check digit;
* ``phone``: a plus sign and 9 to 15 digits with the usual punctuation;
* ``iban``: two letters, two check digits and as many more as the country has, which pass the modulo 97
  test; for letters that are no registered country 11 to 30 more, the longest that ends a word and passes;
* ``key``: access key ids that begin with a fixed cue;
* ``secret``: the value after a cue such as ``password=`` or ``token =``.
* ``userinfo``: the user and password part of an address with a scheme.

Within one kind, spans are leftmost, do not overlap, and are half-open in code points.
A null or empty text has no spans; repeated rows give equal results; other columns of
the input pass through ``find_spans`` untouched, but for one that has the name of its result.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from .tables import free_name, map_slices

#: Kinds in the order in which spans of one start are listed.
KINDS = ("email", "ip", "card", "phone", "iban", "key", "secret", "userinfo")
BASE_KINDS = KINDS[:4]
SPAN_TYPE = "array<struct<kind:string,start:bigint,end:bigint>>"

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
#: Characters of an account by country.
_IBAN_LENGTH = {code: int(length) for length, codes in (line.split(":") for line in (
    "15:NO", "16:BE", "18:DK FI FK FO GL NL SD", "19:MK SI", "20:AT BA EE KZ LT LU MN XK", "21:CH HR LI LV",
    "22:BG BH CR DE GB GE IE ME RS VA", "23:AE GI IL IQ OM SO TL", "24:AD CZ ES MD PK RO SA SE SK TN VG", "25:LY PT ST",
    "26:IS TR", "27:BI DJ FR GR IT MC MR SM", "28:AL AZ BY CY DO GT HN HU LB NI PL SV", "29:BR EG PS QA UA",
    "30:JO KW MU YE", "31:MT SC", "32:LC", "33:RU")) for code in codes.split()}
_IBAN_OF = {n: re.compile(rf"[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}(?![A-Za-z0-9])") for n in set(_IBAN_LENGTH.values())}
_KEY = re.compile(r"A(?:KIA|SIA)[A-Z0-9]{16}(?![A-Za-z0-9])")
_ASSIGNED = re.compile(r"\s{0,3}[:=]\s{0,3}[\"']?([A-Za-z0-9+/_.-]{12,})")
_USERINFO = re.compile(r"[A-Za-z0-9._%+~-]+:[^\s/@:]+(?=@)")
_CUES = ("password", "passwd", "pwd", "token", "secret", "api_key", "apikey", "api-key")


def _luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _iban_valid(text: str) -> bool:
    plain = text.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1


def _iban_end(text: str, at: int) -> int:
    """End of the account that begins at ``at``; -1 if there is none."""
    length = _IBAN_LENGTH.get(text[at:at + 2])
    if not (m := (_IBAN_OF[length] if length else _IBAN).match(text, at)):
        return -1
    end = len(m[0])
    while not length and end > 0 and not _iban_valid(m[0][:end]):
        end = m[0].rfind(" ", 0, end)
    if end < 0 or len(m[0][:end].replace(" ", "")) < 15 or not _iban_valid(m[0][:end]):
        return -1
    return at + end


def _automaton():
    found = ahocorasick.Automaton()
    for digit in "0123456789":
        found.add_word(digit, ("digit", 1))
    found.add_word("@", ("at", 1))
    found.add_word("://", ("scheme", 3))
    found.add_word("AKIA", ("key", 4))
    found.add_word("ASIA", ("key", 4))
    for cue in _CUES:
        for form in (cue, cue.upper(), cue.capitalize()):
            found.add_word(form, ("cue", len(form)))
    found.make_automaton()
    return found


def text_spans(text: str | None, automaton=None) -> list[tuple[str, int, int]]:
    """All spans of one text by start, then kind as listed, then end."""
    if not text:
        return []
    spans: list[tuple[str, int, int]] = []
    done = dict.fromkeys(KINDS, 0)

    def take(kind: str, start: int, end: int, valid: bool = True) -> None:
        done[kind] = end
        if valid:
            spans.append((kind, start, end))

    for last, (anchor, width) in (automaton or _automaton()).iter(text):
        at = last + 1 - width
        if anchor == "digit":
            if at >= done["ip"] and (at == done["ip"] or not "0" <= text[at - 1] <= "9") and (m := _IP.match(text, at)):
                take("ip", at, m.end(), all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")))
            if at >= done["card"] and (m := _CARD.match(text, at)):
                digits = m[0].replace(" ", "").replace("-", "")
                take("card", at, m.end(), 12 <= len(digits) <= 19 and _luhn(digits))
            if at > done["phone"] and text[at - 1] == "+" and (m := _PHONE.match(text, at - 1)):
                take("phone", at - 1, m.end(), 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15)
            if at >= max(2, done["iban"] + 2) and (at == 2 or not text[at - 3].isalnum()) and (end := _iban_end(text, at - 2)) > 0:
                take("iban", at - 2, end)
        elif anchor == "at":
            start = at
            while start > done["email"] and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                take("email", start, m.end())
        elif anchor == "key":
            if at >= done["key"] and (at == 0 or not text[at - 1].isalnum()) and (m := _KEY.match(text, at)):
                take("key", at, m.end())
        elif anchor == "cue":
            if (m := _ASSIGNED.match(text, last + 1)) and m.start(1) >= done["secret"] and any(c.isdigit() for c in m[1]):
                take("secret", m.start(1), m.end(1))
        elif last + 1 >= done["userinfo"] and (m := _USERINFO.match(text, last + 1)):
            take("userinfo", m.start(), m.end())
    order = {kind: i for i, kind in enumerate(KINDS)}
    spans.sort(key=lambda s: (s[1], order[s[0]], s[2]))
    return spans


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with every span replaced by its kind; of overlapping spans the leftmost, then longest, names the gap."""
    if not spans:
        return text
    parts, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(parts) + text[at:]


def _mapped(df: DataFrame, text: str, name: str, kind: str, arrow: pa.DataType, value: Callable) -> DataFrame:
    """``df`` with column ``name`` computed from each text; a column of that name is replaced."""
    df, built = df.drop(name), []

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not built:
            built.append(_automaton())
        made = pa.array([value(t, built[0]) for t in batch.column(batch.schema.get_field_index(text)).to_pylist()], arrow)
        return pa.RecordBatch.from_arrays([*batch.columns, made], names=[*batch.schema.names, name])

    made = StructField(name, _parse_datatype_string(kind))
    return map_slices(df, work, StructType([*df.schema.fields, made]), text)


def find_spans(df: DataFrame, text: str = "text", name: str = "pii_spans") -> DataFrame:
    """``df`` with the spans of every text as an array of (kind, start, end)."""
    arrow = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    return _mapped(df, text, name, SPAN_TYPE, arrow, lambda t, a: [
        {"kind": k, "start": s, "end": e} for k, s, e in text_spans(t, a)])


def redact_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with every span in ``text`` replaced by ``<KIND>``; a null stays null."""
    name = free_name(df, "redacted")
    made = _mapped(df, text, name, "string", pa.string(), lambda t, a: redact(t, text_spans(t, a)))
    return made.select(*(made[name].alias(c) if c == text else made[c] for c in df.columns))


def spans_text(spans: str, kinds: tuple[str, ...] = KINDS):
    """Spans as ``kind:start:end``, comma-joined in order."""
    listed = ", ".join(f"'{k}'" for k in kinds)
    return F.expr(f"array_join(transform(filter({spans}, s -> s.kind IN ({listed})), "
                  "s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def personal_data(documents: DataFrame) -> DataFrame:
    """The digest of all spans per document: counts per base kind, checksum of base spans, all spans."""
    found = find_spans(documents.select("doc_id", "text"))
    counts = [F.expr(f"CAST(size(filter(pii_spans, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in BASE_KINDS]
    return found.select("doc_id", *counts, F.sha2(spans_text("pii_spans", BASE_KINDS), 256).alias("base_sha256"),
                        spans_text("pii_spans").alias("spans"))
