"""Personal data: fixed patterns, and a character-level BiLSTM with CRF transitions trained on their spans.

The tagger learns from windows around the spans that the patterns find in a bounded sample of windows,
and from windows without any. It finds what the patterns lose by taking the leftmost and longest match
and not trying again: a card number next to other digits, a phone number without its plus sign.

Every kind needs a digit or an @. So only stretches within half a window of such a character are
scored, in overlapping windows, and one search over each whole stretch reconciles them; a span without
such a character would be refused anyway.
"""

from __future__ import annotations

import io
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tagger
from .words import slices

KINDS = ("email", "ip", "card", "phone")
TAGS = 1 + 2 * len(KINDS)  # outside; begin and inside of each kind
TRIGGER = re.compile("[0-9@]")
Span = tuple[int, int, int]  # number of the kind, start, end in code points

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A match can only start where its run starts: later in the run the same characters follow.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(digits: str) -> bool:
    """The check digit of card numbers."""
    total = 0
    for place, c in enumerate(reversed(digits)):
        value = int(c) << (place & 1)
        total += value - 9 if value > 9 else value
    return total % 10 == 0


def _is_ip(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def _is_card(text: str) -> bool:
    digits = _digits(text)
    return 14 <= len(digits) <= 19 and luhn(digits)


def _is_phone(text: str) -> bool:
    return 10 <= len(_digits(text)) <= 15


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            done = domain.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """What the patterns find, leftmost and without overlap per kind, by start and kind."""
    if TRIGGER.search(text) is None:
        return []
    found = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    for kind, pattern, valid in ((1, _IP, _is_ip), (2, _CARD, _is_card), (3, _PHONE, _is_phone)):
        found += [(kind, m.start(), m.end()) for m in pattern.finditer(text) if valid(m[0])]
    return sorted(found, key=lambda s: (s[1], s[0]))


#: What a span of the tagger must look like, as a whole.
_SHAPES = (
    (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), lambda t: True),
    (re.compile(r"[0-9]+(?:\.[0-9]+){3}"), _is_ip),
    (re.compile(r"[0-9](?:[ -]?[0-9])+"), _is_card),
    (re.compile(r"[+(0-9][ ().0-9-]+[0-9]"), _is_phone),
)


def stretches_of(text: str, reach: int) -> list[tuple[int, int]]:
    """The stretches within reach of a digit or an @."""
    out: list[tuple[int, int]] = []
    for m in TRIGGER.finditer(text):
        a, b = max(m.start() - reach, 0), min(m.end() + reach, len(text))
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def tagged_spans(text: str, offset: int, tags: np.ndarray, base: list[Span]) -> list[Span]:
    """Spans that the tags of text[offset:offset + len(tags)] add to the base ones.

    A span must have the shape of its kind, must not continue a word and must not touch a base span.
    """
    out, kinds = [], np.where(tags > 0, (tags.astype(int) + 1) // 2, 0)
    begins = (kinds > 0) & ((np.r_[0, kinds[:-1]] != kinds) | (tags % 2 == 1))
    for a in np.flatnonzero(begins):
        b = a + 1
        while b < len(tags) and kinds[b] == kinds[a] and not begins[b]:
            b += 1
        kind, start, end = int(kinds[a]) - 1, offset + int(a), offset + int(b)
        while start < end and text[start].isspace():
            start += 1
        while start < end and (text[end - 1].isspace() or text[end - 1] == "."):
            end -= 1
        body, (shape, valid) = text[start:end], _SHAPES[kind]
        alone = not (start and text[start - 1].isalnum()) and not (end < len(text) and text[end].isalnum())
        free = all(end <= s or e <= start for _, s, e in base)
        if alone and free and shape.fullmatch(body) and valid(body):
            out.append((kind, start, end))
    return out


def find_spans(texts: list[str], model: tagger.Tagger | None) -> list[tuple[list[Span], list[Span]]]:
    """For each text the base spans and all spans, by start and kind."""
    base = [base_spans(t) for t in texts]
    if model is None:
        return [(b, b) for b in base]
    places = [(n, a, b) for n, t in enumerate(texts) for a, b in stretches_of(t, model.window // 2)]
    tags = model.tag([texts[n][a:b] for n, a, b in places])
    full = [list(b) for b in base]
    for (n, a, _), found in zip(places, tags, strict=True):
        full[n] += tagged_spans(texts[n], a, found, base[n])
    return [(b, sorted(f, key=lambda s: (s[1], s[0]))) for b, f in zip(base, full, strict=True)]


def _line(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def _windows(size: int):
    """Training windows: one around each base span, and one for each stretch without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, str, bytes]] = []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                centres = [(kind, a) for kind, a, _ in spans]
                centres += [
                    (len(KINDS), (a + b) // 2)
                    for a, b in stretches_of(text, size // 2)
                    if not any(s < b and a < e for _, s, e in spans)
                ]
                for kind, centre in centres:
                    begin = max(0, centre - zlib.crc32(text[centre : centre + 32].encode()) % (size - 16) - 8)
                    tags = np.zeros(len(text[begin : begin + size]), np.int8)
                    for k, a, b in reversed(spans):
                        if a < begin + size and b > begin:
                            tags[max(a - begin, 0) : b - begin] = 2 * k + 2
                            if a >= begin:
                                tags[a - begin] = 2 * k + 1
                    rows.append((kind, text[begin : begin + size], tags.tobytes()))
            columns = list(zip(*rows, strict=True)) or [(), (), ()]
            types = (pa.int32(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_pydict(
                {n: pa.array(c, t) for n, c, t in zip(("kind", "text", "tags"), columns, types, strict=True)}
            )

    return run


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    windows, tags = [], []
    for batch in batches:
        windows += [tagger.encode(t) for t in batch.column("text").to_pylist()]
        tags += [np.frombuffer(t, np.int8).astype(np.int64) for t in batch.column("tags").to_pylist()]
    if windows:
        packed = io.BytesIO()
        np.savez(packed, **tagger.train(windows, tags, TAGS))
        yield pa.RecordBatch.from_pydict({"weights": [packed.getvalue()]})


def train(docs: DataFrame, per_kind: int = 300, window: int = 96) -> tagger.Tagger | None:
    """A tagger from at most `per_kind` distinct windows of each kind and without any, chosen by hash.

    The windows are cut from all documents; the bound holds for the training only. None without windows.
    """
    texts = docs.select("text").filter(F.col("text").rlike("[0-9@]"))
    found = texts.mapInArrow(_windows(window), "kind int, text string, tags binary").distinct()
    by_hash = Window.partitionBy("kind").orderBy(F.xxhash64("text", "tags"), "text", "tags")
    chosen = found.withColumn("rank", F.row_number().over(by_hash)).filter(F.col("rank") <= per_kind)
    row = chosen.repartition(1).sortWithinPartitions("rank", "kind").select("text", "tags").mapInArrow(_train, "weights binary").first()
    if row is None:
        return None
    with np.load(io.BytesIO(row["weights"])) as stored:
        return tagger.Tagger(dict(stored), window, window // 2)


def _triggered(batch: pa.RecordBatch, model: tagger.Tagger | None) -> dict[int, tuple[list[Span], list[Span]]]:
    """Spans by row, for the rows that have any digit or @."""
    has = pc.fill_null(pc.match_substring_regex(batch.column("text"), "[0-9@]"), False)
    rows = np.flatnonzero(has.to_numpy(zero_copy_only=False))
    texts = batch.column("text").take(pa.array(rows)).to_pylist()
    return dict(zip(rows.tolist(), find_spans(texts, model), strict=True))


def _report(model: tagger.Tagger | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = _triggered(part, model)
                each = [found.get(i, ([], [])) for i in range(part.num_rows)]
                counts = {f"n_{k}": [sum(s[0] == n for s in base) for base, _ in each] for n, k in enumerate(KINDS)}
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": part.column("doc_id"),
                        **{n: pa.array(c, pa.int64()) for n, c in counts.items()},
                        "base": pa.array([_line(b) for b, _ in each], pa.string()),
                        "spans": pa.array([_line(f) for _, f in each], pa.string()),
                    }
                )

    return run


def find_personal_data(docs: DataFrame, model: tagger.Tagger | None) -> DataFrame:
    """Per row of docs (doc_id long, text): doc_id, n_email, n_ip, n_card, n_phone, base, spans.

    The counts and `base` are of the patterns, `spans` has the tagger's spans too; both list
    kind:start:end in code points by start and kind, joined by commas. Null and empty texts have none.
    Rows that share a doc_id, or have none, are treated one by one. Other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return rows.mapInArrow(_report(model), f"doc_id long, {counts}, base string, spans string")


def _masked(text: str, spans: list[Span]) -> str:
    out, done = [], 0
    for kind, a, b in spans:
        if a >= done:
            out += [text[done:a], f"[{KINDS[kind].upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]])


def _mask(model: tagger.Tagger | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = {i: full for i, (_, full) in _triggered(part, model).items() if full}
                texts = part.column("text").to_pylist() if found else []
                for i, full in found.items():
                    texts[i] = _masked(texts[i], full)
                at = part.schema.get_field_index("text")
                yield part.set_column(at, part.schema.field(at), pa.array(texts, part.schema.field(at).type)) if found else part

    return run


def mask_personal_data(docs: DataFrame, model: tagger.Tagger | None) -> DataFrame:
    """All rows and columns, with every span of the text replaced by its kind, like [EMAIL].

    Of overlapping spans the first gives the kind and all their characters go. Null and empty texts stay.
    """
    return docs.mapInArrow(_mask(model), docs.schema)
