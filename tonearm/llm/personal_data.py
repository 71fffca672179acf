"""Personal data: patterns propose spans, checksums confirm them, words nearby adjust their scores.

Every kind has a pattern with a score of its own. Where the kind has a checksum or a rule (Luhn
for cards, mod-97 for account numbers, ranges of address parts, area numbers), spans that fail it
go and spans that pass gain. Words near a span that belong to its kind raise the score, words that
speak against it lower it. A span is kept from `THRESHOLD` on.

The four base kinds (e-mail, ip, card, phone) are kept by pattern and rule alone: words nearby
change their score, but not below the threshold. The further kinds need a checksum or a word:
account numbers (iban) stand on mod-97, addresses of IP version 6 on their parsing, social
security numbers and phone numbers without a country code on a word nearby. The two that stand
on a word give way to base spans they overlap.

The patterns are searched in time linear in the text: a run of digits or of name characters is
taken as a whole, and is not tried again from each of its characters.
"""

from __future__ import annotations

import ipaddress
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tonearm.llm.blocks import mapped
from tonearm.llm.texts import batch, text_slices

#: Kinds in the order in which spans with the same start are listed.
BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "iban", "ipv6", "ssn", "local_phone")
THRESHOLD = 0.5
#: Code points before and behind a span in which words count.
BEFORE, BEHIND = 60, 30
CONFIRMED, SUPPORTED, OPPOSED = 0.4, 0.3, -0.2
#: Score of a match of the pattern alone.
PATTERN = {
    "email": 0.8, "ip": 0.5, "card": 0.3, "phone": 0.6, "iban": 0.4, "ipv6": 0.3, "ssn": 0.3, "local_phone": 0.3,
}
#: Words that speak for a kind.
WORDS_FOR = {
    "email": "email e-mail mail contact write",
    "ip": "ip address host server login",
    "card": "card credit visa mastercard payment karte tarjeta carte",
    "phone": "phone call tel telephone mobile fax telefon teléfono téléphone",
    "iban": "iban account bank konto cuenta compte",
    "ipv6": "ip ipv6 address host server",
    "ssn": "ssn social security",
    "local_phone": "phone call tel telephone mobile fax telefon teléfono téléphone",
}
#: Words that speak against any kind.
WORDS_AGAINST = "example version isbn order invoice serial part"
#: Length of an account number by its country.
IBAN_LENGTH = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20,
    "ES": 24, "FI": 18, "FR": 27, "GB": 22, "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27,
    "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28, "PT": 25, "RO": 24,
    "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26,
}

_LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]+(?:\.[0-9]+)*")
_DIGITS = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_COLONS = re.compile(r":[0-9A-Fa-f:]+")
_HEX = frozenset("0123456789abcdefABCDEF")
_SSN = re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")
_LOCAL_PHONE = re.compile(r"\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}")

Span = tuple[int, int]


def _word_pattern(words: str) -> re.Pattern:
    return re.compile(r"(?<!\w)(?:" + "|".join(map(re.escape, words.split())) + r")(?!\w)")


_FOR = {kind: _word_pattern(words) for kind, words in WORDS_FOR.items()}
_AGAINST = _word_pattern(WORDS_AGAINST)


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[-1::-2]))) % 10 == 0


def mod97(number: str) -> bool:
    """Whether an account number, without spaces, leaves 1: its first four characters count as the last."""
    return int("".join(str(int(c, 36)) for c in number[4:] + number[:4])) % 97 == 1


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def emails(text: str) -> Iterator[Span]:
    """The name in front of an at sign reaches back over all name characters, to the match before at most."""
    floor = 0
    for found in _DOMAIN.finditer(text):
        at = found.start()
        start = floor + len(text[floor:at].rstrip(_LOCAL_PART))
        floor = at + 1
        if start < at:
            floor = found.end()
            yield start, floor


def ips(text: str) -> Iterator[Span]:
    """A run of numbers with dots between them is taken four numbers at a time."""
    for found in _DOTTED.finditer(text):
        numbers, at = found.group().split("."), found.start()
        for i in range(0, len(numbers) - 3, 4):
            four = numbers[i : i + 4]
            end = at + sum(map(len, four)) + 3
            if all(len(n.lstrip("0")) < 4 and int(n.lstrip("0") or 0) <= 255 for n in four):
                yield at, end
            at = end + 1


def cards(text: str) -> Iterator[Span]:
    for found in _DIGITS.finditer(text):
        if found.end() - found.start() <= 38:
            digits = _digits(found.group())
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield found.span()


def phones(text: str) -> Iterator[Span]:
    for found in _PHONE.finditer(text):
        if 10 <= len(_digits(found.group())) <= 15:
            yield found.span()


def _alone(text: str, start: int, stop: int) -> bool:
    return not (text[start - 1 : start].isalnum() or text[stop : stop + 1].isalnum())


def ibans(text: str) -> Iterator[Span]:
    """What follows an account number can look like more of it: the country tells where it ends."""
    for found in _IBAN.finditer(text):
        body, length = found.group(), IBAN_LENGTH.get(found.group()[:2])
        places = [i for i, c in enumerate(body) if c != " "]
        if length and length <= len(places):
            stop = found.start() + places[length - 1] + 1
            if _alone(text, found.start(), stop) and mod97("".join(body[i] for i in places[:length])):
                yield found.start(), stop


def ipv6s(text: str) -> Iterator[Span]:
    """Three groups at least: times of the day and lists with colons are no addresses."""
    for found in _COLONS.finditer(text):
        start, stop = found.span()
        while start and found.start() - start < 4 and text[start - 1] in _HEX:
            start -= 1
        if stop - start > 39 or not _alone(text, start, stop) or sum(map(bool, text[start:stop].split(":"))) < 3:
            continue
        try:
            ipaddress.IPv6Address(text[start:stop])
        except ValueError:
            continue
        yield start, stop


def ssns(text: str) -> Iterator[Span]:
    for found in _SSN.finditer(text):
        area, group, serial = found.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000" and _alone(text, *found.span()):
            yield found.span()


def local_phones(text: str) -> Iterator[Span]:
    return (found.span() for found in _LOCAL_PHONE.finditer(text) if _alone(text, *found.span()))


FINDERS = {
    "email": emails, "ip": ips, "card": cards, "phone": phones, "iban": ibans, "ipv6": ipv6s, "ssn": ssns,
    "local_phone": local_phones,
}
#: Kinds whose finder checks a sum or parses the value; the others have a pattern and a rule on its digits.
CHECKED = {"ip", "card", "iban", "ipv6"}


def score(text: str, kind: str, start: int, stop: int) -> float:
    """Score of a span that its finder gave, with the words around it; from 0 to 1."""
    around = (text[max(0, start - BEFORE) : start] + "\n" + text[stop : stop + BEHIND]).lower()
    value = PATTERN[kind] + CONFIRMED * (kind in CHECKED)
    value += SUPPORTED * bool(_FOR[kind].search(around)) + OPPOSED * bool(_AGAINST.search(around))
    return round(min(1.0, max(THRESHOLD if kind in BASE else 0.0, value)), 2)


def find_spans(text: str) -> list[tuple[str, int, int, float]]:
    """(kind, start, stop, score) of all spans of a text, in code points, by start and kind."""
    kept: list[tuple[str, int, int, float]] = []
    for kind in KINDS:
        first = sorted((a, b) for k, a, b, _ in kept if k in BASE) if kind in ("ssn", "local_phone") else []
        at = 0
        for start, stop in FINDERS[kind](text):
            while at < len(first) and first[at][0] < stop and first[at][1] <= start:
                at += 1
            if at < len(first) and first[at][0] < stop:
                continue
            value = score(text, kind, start, stop)
            if value >= THRESHOLD:
                kept.append((kind, start, stop, value))
    return sorted(kept, key=lambda span: (span[1], KINDS.index(span[0])))


def redacted(text: str, spans: list[tuple[str, int, int, float]]) -> str:
    """The text with each span replaced by its kind in brackets; of overlapping spans the first, prolonged."""
    out, at = [], 0
    for kind, start, stop, _ in spans:
        if start >= at:
            out += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, stop)
    return "".join([*out, text[at:]])


SPAN = "array<struct<kind: string, start: bigint, stop: bigint, score: double>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("score", pa.float64())]))


def find_personal_data(df: DataFrame, doc_id: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """One row per input row: doc_id and `found`, the spans with kind, start, stop (code points) and score.

    `with_text` adds `redacted`, the whole text with its spans replaced. A null text has no spans and
    stays null, an empty one stays empty. Spans are listed by start, those of one start in the order
    of `KINDS`. Repeated rows are each judged alike, a row without id keeps its null; other columns of
    the input are left out, whatever their names. An empty table gives no rows. Texts are searched whole.
    """

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            texts = rows.column("text")
            for first, last, data, offsets in text_slices(texts):
                own = [data[a:b].tobytes().decode() for a, b in zip(offsets[:-1], offsets[1:])]
                spans = [find_spans(one) for one in own]
                listed = [[dict(zip(("kind", "start", "stop", "score"), s)) for s in found] for found in spans]
                out = {"doc_id": rows.column("doc_id").slice(first, last - first), "found": (listed, _SPAN_TYPE)}
                if with_text:
                    changed = [redacted(one, found) if texts[first + i].is_valid else None for i, (one, found) in enumerate(zip(own, spans))]
                    out["redacted"] = (changed, pa.string())
                yield batch(**out)

    rows = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.transform(mapped, find, f"doc_id long, found {SPAN}" + (", redacted string" if with_text else ""))


def listed_spans(found: DataFrame) -> DataFrame:
    """Counts of the base kinds, the digest of the base spans and all spans as one text, from `found`."""
    is_base = " OR ".join(f"s.kind = '{kind}'" for kind in BASE)
    joined = "array_join(transform({0}, s -> concat_ws(':', s.kind, s.start, s.stop)), ',')"
    return found.select(
        "doc_id",
        *[F.expr(f"CAST(size(filter(found, s -> s.kind = '{kind}')) AS BIGINT)").alias(f"n_{kind}") for kind in BASE],
        F.sha2(F.expr(joined.format(f"filter(found, s -> {is_base})")), 256).alias("base_sha256"),
        F.expr(joined.format("found")).alias("spans"),
    )
