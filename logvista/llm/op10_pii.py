"""Surrogates for personal data.

Entities found in a text (addresses, telephone, card, account and network numbers, secrets, and names after a title) are
replaced by keyed ones of their own type: a number keeps its length, its punctuation and its check digit's validity, a name
its gender and its script, an address its shape. What is replaced is the entity and not the mention, so that mentions in other
formats or documents stay the same person: a name is one entity whatever its title, and once a title has told it, every
capitalised mention of it in that document is replaced. Its gender is what the titles of the whole corpus say. Surrogates of
different entities are kept apart by a check over the whole corpus: where two would coincide, or one would be another real
entity, it is drawn again, and grows after some draws, so that there is always another. Only such exceptions, and names whose
gender other documents tell, are handed to the pass that writes the texts, which otherwise derives every surrogate from the
key and the text alone.

What is found, and nothing else: e-mail addresses of letters, digits and ``_ . + -``, in any script; IPv4 and IPv6 addresses;
card numbers with a valid check digit, of 13 to 19 digits from 3 to 6 in groups of four or without groups, of 16 from 22 to
27, and in groups of 4, 6 and 5; international account numbers with a valid check number, in groups of four or without
groups; social security numbers as 123-45-6789; telephone numbers as +1 555 555 1234 with or without the country code and
parentheses, in at least seven digits that are no date or book number, and after + as 14155552671, 33 1 23 45 67 89 and 49 30
1234567; AKIA keys; after ``password``, ``passwd``, ``secret``, ``token`` or ``api_key`` (also ``api-key``, ``apikey``),
alone or at the end of a longer label, and = or :, runs of 8 or more letters and digits of ASCII and ``+ / ~ _ -``, with dots
inside; and any number of capitalised names after a title.
"""

from __future__ import annotations

import hashlib
import hmac
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textbytes as tb
from .shared import Workspace, broadcast_if_small, free_name, join_split, read_table

#: Texts with an exception up to which those are broadcast; beyond, frequent texts' are and the others are joined by a shuffle.
FEW = 50_000
ROUNDS = 40

# Titles that announce a name, by the gender they tell.
MALE = ("Mr", "Herr", "Señor", "Monsieur", "Господин", "Κύριος")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Señora", "Madame", "Госпожа", "Κυρία")
EITHER = ("Dr", "Prof")

_NAME = r"[^\W\d_a-zа-яα-ω][^\W\d_]+"
_WORD = re.compile(r"[^\W\d_]+")
_DOMAIN = re.compile(r"@[\w-]{1,63}(?:\.[\w-]{1,63})*\.(?:xn--[A-Za-z0-9-]{2,59}|[^\W\d_]{2,24})(?![\w-])")
_LOCAL = re.compile(r"(?<![\w.+-])\w[\w.+-]{0,63}$")
_LABEL = re.compile(r"(?:(?<![^\W_])|(?<=[a-z])(?=[A-Z]))(?i:password|passwd|secret|token|api[_-]?key)[\"']?\s{0,3}$")
_SECRET = re.compile(r"[=:]\s{0,3}[\"']?([A-Za-z0-9+/~_-]+(?:\.{1,2}[A-Za-z0-9+/~_-]+)*(?<=[A-Za-z0-9+/~_.-]{8}))(?!\w)")
_H = "[0-9A-Fa-f]{1,4}"
_IPV6 = re.compile(rf"(?<![\w:.])(?:(?:{_H}:){{7}}{_H}|(?=[A-Fa-f:]*\d)(?:{_H}(?::{_H}){{0,6}})?::(?:{_H}(?::{_H}){{0,6}})?)(?![\w:])")
_IBAN = re.compile(r"[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?!\w)")
_KEY = re.compile(r"AKIA[A-Z0-9]{16}(?!\w)")
_NAMES = re.compile(rf"({'|'.join(MALE + FEMALE + EITHER)})\.?\s({_NAME}(?:[ -]{_NAME})*)")
_NUMBER = re.compile(
    r"(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\w|\.\d))"
    r"|(?P<ssn>(?<![\w.-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<card>(?<![\w.-])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?:(?<=[ -]\d{4})[ -]\d{1,3})?(?![\w-])"
    r"|(?<![\w.-])(?:2[2-7]\d\d(?:[ -]?\d{4}){3}|3[47]\d\d[ -]\d{6}[ -]\d{5})(?![\w-]))"
    r"|(?P<phone>(?<![\w.])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,4}\)[ .-]?|\d{2,4}[ .-])\d{3,4}[ .-]\d{3,4}(?![\w-]|[ .-]\d)"
    r"|(?<![\w.])\+[1-9](?:\d{6,14}|\d{0,2}[ .-]?\d(?:[ .-]\d{2}){4}|\d{0,2}[ .-]\(?\d{2,5}\)?[ .-]\d{4,9})(?![\w-]))"
)
_START = re.compile(r"[+(]*\d")
_TRIGGER = np.zeros(256, bool)
_TRIGGER[list(b"0123456789@=:")] = True
_TITLE = re.compile("|".join((*MALE, *FEMALE, *EITHER)).encode())
_SCRIPTS = (("cyrillic", "бвгдзклмнрст", "аеиоу", "а"), ("greek", "βγδκλμνπρσ", "αεοι", "α"), ("latin", "bdfgklmnprstv", "aeiou", "a"))


def _script(text: str) -> str:
    c = ord(text[0])
    return "cyrillic" if 0x400 <= c < 0x530 else "greek" if 0x370 <= c < 0x400 else "latin"


def _card(value: str) -> str | None:
    """The part of a number in card form whose check digit is valid: all of it, or all but a short last group, or none."""
    parts = re.fullmatch(r"((?:\d{4}[ -]){3}\d{4})[ -]\d{1,3}", value)
    return next((v for v in (value, parts and parts[1]) if v and luhn(re.sub(r"\D", "", v)) == 0), None)


def _iban(value: str) -> str | None:
    """The longest part, by whole groups, whose check number is valid."""
    while len(plain := value.replace(" ", "")) >= 15:
        if len(plain) <= 34 and mod97(plain) == 1:
            return value
        value = value.rpartition(" ")[0]
    return None


def _phone(value: str, before: str) -> bool:
    """Whether digits in telephone form are no book number, and not part of a longer row of numbers."""
    digits = re.sub(r"\D", "", value)
    book = (len(digits) in (10, 13) and digits[:3] in ("978", "979")) or re.search(r"(?i:isbn|issn)\W*$", before)
    date = re.fullmatch(r"(?:19|20)\d\d[ .-](?:0\d|1[0-2])\d{0,2}[ .-]\d{3,4}", value)
    return not book and not date and not re.search(r"\d[ .-]$", before)


def _before(text: str, at: int, chars: str) -> int:
    """Where the run of ``chars`` that ends before ``at`` begins."""
    while at and text[at - 1] in chars:
        at -= 1
    return at


def _marked(text: str) -> Iterator[tuple[int, int, str, str, int]]:
    """All that a character or word marks; each kind is looked for only where its mark stands."""
    if "@" in text:
        for m in re.finditer("@", text):
            low = max(0, m.start() - 65)
            local = _LOCAL.search(text[low : m.start()])  # a mark further left can only mean that the name is longer than 64
            domain = local and (low == 0 or local.start() > 0) and _DOMAIN.match(text, m.start())
            if domain:
                yield low + local.start(), domain.end(), "email", text[low + local.start() : domain.end()].casefold(), 0
    if "::" in text or text.count(":") >= 7:
        for m in re.finditer(":", text):
            if address := _IPV6.match(text, _before(text, m.start(), "0123456789abcdefABCDEF")):
                yield *address.span(), "ipv6", address[0].casefold(), 0
    for m in re.finditer("[=:]", text):
        if _LABEL.search(text[max(0, m.start() - 16) : m.start()]) and (value := _SECRET.match(text, m.start())):
            yield *value.span(1), "secret", value[1], 0
    if "AKIA" in text:
        for m in _KEY.finditer(text):
            if not m.start() or not _wordy(text[m.start() - 1]):
                yield *m.span(), "key", m[0], 0
    for m in _IBAN.finditer(text):
        if (not m.start() or not _wordy(text[m.start() - 1])) and (value := _iban(m[0])):
            yield m.start(), m.start() + len(value), "iban", value.replace(" ", ""), 0
    at = 0
    while m := _NAMES.search(text, at):
        at = m.end(1)
        if not m.start() or not _wordy(text[m.start() - 1]):
            gender = 1 if m[1] in MALE else 2 if m[1] in FEMALE else 0
            words = list(itertools.takewhile(lambda w: not w[0][0].islower(), _WORD.finditer(m[2])))
            for w in words:
                yield m.start(2) + w.start(), m.start(2) + w.end(), f"name-{_script(w[0])}", w[0].casefold(), 0 if w is words[-1] else gender
            at = m.start(2) + words[-1].end() if words else at


def _wordy(c: str) -> bool:
    return c.isalnum() or c == "_"


def _numbers(text: str, at: int, to: int) -> Iterator[tuple[int, int, str, str, int]]:
    """Numbers of a stretch of text."""
    low = at  # where the last entity ends
    while start := _START.search(text, at, to):
        m = _NUMBER.match(text, start.start()) or (_NUMBER.match(text, start.end() - 1) if start.end() - start.start() > 1 else None)
        if not m or m.end() > to:
            at = start.end()
            while at < to and text[at].isdigit():
                at += 1
            continue
        kind, at, value = m.lastgroup, m.end(), m[0]
        if kind == "card":
            value = _card(value)
            at = m.start() + len(value or m[0])
        elif kind == "phone" and not _phone(value, text[max(low, m.start() - 12) : m.start()]):
            value = None
        if value:
            low = at
            yield m.start(), m.start() + len(value), kind, value if kind == "ip" else re.sub(r"\D", "", value), 0


def find(text: str) -> list[tuple[int, int, str, str, int]]:
    """(start, end, type, entity, gender) of all mentions, in order and apart; two mentions of one entity have equal types and entities.

    Gender, of given names only, is 1 (male), 2 (female) or 0, by the title. Where mentions overlap the first counts.
    """
    out: list[tuple] = []
    at = 0
    for found in sorted({(m[0], -m[1]): m for m in _marked(text)}.values(), key=lambda m: (m[0], -m[1])):
        if found[0] >= at:
            out += _numbers(text, at, found[0])
            out.append(found)
            at = found[1]
    out += _numbers(text, at, len(text))
    names = {m[3] for m in out if m[2].startswith("name")}
    return _again(text, out, names) if names else out


def _again(text: str, found: list[tuple], names: set[str]) -> list[tuple]:
    """``found`` with the capitalised mentions of its names that no title announces."""
    out, i = [], 0
    for w in _WORD.finditer(text):
        while i < len(found) and found[i][1] <= w.start():
            out.append(found[i])
            i += 1
        if (i == len(found) or w.end() <= found[i][0]) and w[0][0].isupper() and w[0].casefold() in names:
            if not ((w.start() and text[w.start() - 1] in "_0123456789") or (w.end() < len(text) and text[w.end()] in "_0123456789")):
                out.append((w.start(), w.end(), f"name-{_script(w[0])}", w[0].casefold(), 0))
    return out + found[i:]


class _Draw:
    """Numbers drawn from the key, an entity and the number of the attempt."""

    def __init__(self, key: bytes, *what: str):
        self.key, self.what, self.n, self.block = key, "\x1f".join(what).encode(), 0, b""

    def below(self, n: int) -> int:
        if len(self.block) < 8:
            self.block += hmac.new(self.key, self.what + self.n.to_bytes(4, "big"), hashlib.sha256).digest()
            self.n += 1
        value, self.block = int.from_bytes(self.block[:8], "big"), self.block[8:]
        return value % n

    def like(self, text: str) -> str:
        """Letters for letters, digits for digits; hexadecimal stays hexadecimal."""
        hexa = re.fullmatch(r"[0-9a-f]+", text) is not None
        pick = lambda s: s[self.below(len(s))]
        lower, upper, digits = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
        return "".join(pick("0123456789abcdef") if hexa else pick(lower) if c.islower() else pick(upper) if c.isupper() else pick(digits) if c.isdigit() else pick(lower) if c.isalnum() else c for c in text)


def luhn(digits: str) -> int:
    return sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(map(int, reversed(digits)))) % 10


def mod97(iban: str) -> int:
    """1 for a valid international account number."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def surrogate(kind: str, entity: str, gender: int, attempt: int, key: bytes) -> str:
    """The entity that takes the place of ``entity``; after some attempts it grows, so that there is always another."""
    draw = _Draw(key, kind, entity, str(attempt))
    more = attempt // 4
    number = lambda n: "".join(str(draw.below(10)) for _ in range(n))
    if kind == "email":
        local, _, domain = entity.partition("@")
        host = _Draw(key, "domain", domain).like("aaaaaaa")
        end = domain.rpartition(".")[2]
        return f"{draw.like(local + 'a' * more)}@{host}.example.{end if end in ('com', 'net', 'org') else 'com'}"
    if kind == "ip" and attempt < 8:
        return ".".join(str(draw.below(254) + 1) for _ in range(4))
    if kind in ("ip", "ipv6"):  # IPv4 addresses that are used up go on in the documentation range of IPv6
        return "2001:db8:" + ":".join(f"{draw.below(1 << 16):x}" for _ in range(6))
    if kind == "card":
        body = entity[0] + number(len(entity) - 1 + more)
        return body[:-1] + str((10 - luhn(body[:-1] + "0")) % 10) if luhn(entity) == 0 else body
    if kind == "iban":
        rest = draw.like(entity[4:] + "0" * more)
        return f"{entity[:2]}{98 - mod97(entity[:2] + '00' + rest):02d}{rest}"
    if kind == "ssn":
        return f"9{number(8 + more)}"  # from 900 on, where none are given
    if kind == "phone":
        keep = 1 if len(entity) > 10 else 0  # the country code's first digit
        return entity[:keep] + number(len(entity) - keep + more)
    if kind == "key":
        return "AKIA" + draw.like(entity[4:] + "A" * more)
    if kind == "secret":
        return draw.like(entity + "a" * more)
    _, consonants, vowels, female = next(s for s in _SCRIPTS if s[0] == kind.rpartition("-")[2])
    pick = lambda s: s[draw.below(len(s))]
    name = "".join(pick(consonants) + pick(vowels) for _ in range(3 + more))
    return name[:-1] + female if gender == 2 else name + pick(consonants) if gender == 1 else name + pick(consonants) + pick(vowels)


def render(mention: str, kind: str, new: str) -> str:
    """``new`` in the format of the mention; characters by which it grew come last."""
    if kind in ("card", "phone", "iban", "ssn"):
        chars = iter(new)
        return "".join(next(chars) if c.isalnum() else c for c in mention) + "".join(chars)
    if kind.startswith("name"):
        return new.upper() if mention.isupper() and len(mention) > 1 else new.capitalize()
    return new.upper() if kind in ("email", "ipv6") and mention.isupper() else new


def _suspects(batch: pa.RecordBatch, column: str) -> np.ndarray:
    """Whether each row's text holds a character or title that every entity has."""
    out = np.zeros(batch.num_rows, bool)
    for at, to, data, bounds in tb.slices(batch, column, 1 << 20):
        hits = np.concatenate([[0], np.cumsum(_TRIGGER[data])])
        out[at:to] = hits[bounds[1:]] > hits[bounds[:-1]]
        for m in _TITLE.finditer(data.tobytes()):
            out[at + int(np.searchsorted(bounds, m.start(), "right")) - 1] = True
    return out


def _detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows (doc, text), (doc, kind, entity, gender): each text's entities once, with what its titles say."""
    for batch in batches:
        docs, rows = batch.column("doc"), []
        for i in np.flatnonzero(_suspects(batch, "text")).tolist():
            seen: dict[tuple, int] = {}
            for *_, kind, entity, gender in find(batch.column("text")[i].as_py()):
                seen[kind, entity] = seen.get((kind, entity), 0) | gender
            rows += [(docs[i].as_py(), *what, gender) for what, gender in seen.items()]
        types = (("doc", pa.int64()), ("kind", pa.string()), ("entity", pa.string()), ("gender", pa.int32()))
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], t) for j, (_, t) in enumerate(types)], names=[n for n, _ in types])


def _attempt(key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = b.to_pylist()
            for r in rows:
                r["attempt"] += r.pop("bad")
                r["new"] = surrogate(r["kind"], r["entity"], r["gender"], r["attempt"], key)
            types = (("kind", pa.string()), ("entity", pa.string()), ("gender", pa.int32()), ("attempt", pa.int32()), ("new", pa.string()))
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], t) for c, t in types], names=[c for c, _ in types])

    return run


def settle(entities: DataFrame, key: bytes, work: Workspace) -> DataFrame:
    """(kind, entity, gender, attempt, new) for distinct (kind, entity), with different ``new`` within each kind, none of them an entity.

    An entity keeps what it has once nothing clashes; of entities that clash the first keeps it. Surrogates grow with the
    attempts, so that this ends.
    """
    schema = "kind string, entity string, gender int, attempt int, new string"
    now = work.keep(entities.select("kind", "entity", "gender", F.lit(0).alias("attempt"), F.lit(0).alias("bad")).mapInArrow(_attempt(key), schema), "surrogates")
    real = entities.select(F.col("kind").alias("k_"), F.col("entity").alias("e_"))
    for _ in range(ROUNDS):
        nth = F.row_number().over(Window.partitionBy("kind", "new").orderBy("attempt", "entity"))
        marked = now.withColumn("nth", nth).join(real, (F.col("kind") == F.col("k_")) & (F.col("new") == F.col("e_")), "left")
        marked = marked.select("kind", "entity", "gender", "attempt", (F.col("e_").isNotNull() | (F.col("nth") > 1)).cast("int").alias("bad"), "new")
        marked = work.keep(marked, "marked")
        bad = marked.where("bad = 1")
        if bad.isEmpty():
            return now
        again = bad.drop("new").mapInArrow(_attempt(key), schema)
        now = work.keep(marked.where("bad = 0").drop("bad").union(again), "surrogates")
    raise RuntimeError(f"surrogates still coincide after {ROUNDS} draws")


def _replace(text_col: str, extra: str, n_col: str, kinds_col: str, key: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, other = batch.column(text_col), batch.column(extra)
            changed: dict[int, str] = {}
            n, kinds = np.zeros(batch.num_rows, np.int32), [""] * batch.num_rows
            for i in np.flatnonzero(_suspects(batch, text_col)).tolist():
                text = texts[i].as_py()
                if found := find(text):
                    said: dict[tuple, tuple[int, int]] = {}
                    for *_, kind, entity, gender in found:
                        said[kind, entity] = (said.get((kind, entity), (0, 0))[0] | gender, 0)
                    said |= {(x["kind"], x["entity"]): (x["gender"], x["attempt"]) for x in other[i].as_py() or ()}
                    parts, at = [], 0
                    for start, end, kind, entity, _ in found:
                        parts += [text[at:start], render(text[start:end], kind, surrogate(kind, entity, *said[kind, entity], key))]
                        at = end
                    changed[i] = "".join(parts) + text[at:]
                    n[i], kinds[i] = len(found), ",".join(sorted({f[2].split("-")[0] for f in found}))
            if changed:
                where = np.zeros(batch.num_rows, bool)
                where[list(changed)] = True
                texts = pc.replace_with_mask(texts.cast(pa.large_string()), pa.array(where), pa.array(list(changed.values()), pa.large_string())).cast(pa.string())
            columns = {c: batch.column(c) for c in batch.schema.names if c != extra} | {text_col: texts, n_col: pa.array(n), kinds_col: pa.array(kinds)}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def replace_private(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with all its columns and rows, entities in ``text_col`` replaced, and two more columns: n_entities (mentions)
    and entity_types (sorted, joined by commas).

    A text without entities is returned as it is, a null text as null and an empty one as empty; texts of any length are read
    whole. Exceptions belong to a text and not to an id, so that repeated rows, texts of one id and rows without id don't
    matter. An empty table gives no rows. Names of the new columns get underscores if they are taken.
    """
    work = Workspace(docs.sparkSession, "pii")
    text = F.col(text_col).cast("string")
    own = docs.select(F.xxhash64(text).alias("doc"), text.alias("text"))  # texts of one hash would only share their exceptions
    mentions = work.keep(own.mapInArrow(_detect, "doc long, kind string, entity string, gender int"), "mentions")
    genders = [F.bit_or("gender").alias("gender"), F.bit_and("gender").alias("least")]
    entities = work.keep(mentions.groupBy("kind", "entity").agg(*genders), "entities")
    final = settle(entities, key, work).join(entities.select("kind", "entity", "least"), ["kind", "entity"])
    again = work.keep(final.where("attempt > 0 or least <> gender").select("kind", "entity", "gender", "attempt"), "again")
    extra, n_col, kinds_col = (free_name(docs, n) for n in ("exceptions", "n_entities", "entity_types"))
    doc = free_name(docs, "exceptions_of")
    each = join_split(mentions.select("doc", "kind", "entity").distinct(), again, ["kind", "entity"], work)
    each = each.groupBy(F.col("doc").alias(doc)).agg(F.collect_set(F.struct("kind", "entity", "gender", "attempt")).alias(extra))
    each = work.keep(each, "exceptions")
    marked = docs.withColumn(text_col, text).withColumn(doc, F.xxhash64(text))
    if (few := broadcast_if_small(each, FEW)) is not each:
        joined = marked.join(few, doc, "left")
    else:
        plain = marked.join(each.select(doc), doc, "left_anti").withColumn(extra, F.lit(None).cast(each.schema[extra].dataType))
        joined = plain.unionByName(join_split(marked, each, [doc], work))
    joined = joined.drop(doc)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema.fields if f.name != extra)
    return joined.mapInArrow(_replace(text_col, extra, n_col, kinds_col, key), f"{schema}, `{n_col}` int, `{kinds_col}` string")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The key is a parameter; this one is for the synthetic tables only."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return replace_private(docs, b"key of the synthetic tables")
