"""Secret scans: wide candidate search, then a random forest that removes false positives.

A candidate is a run of 16 or more letters, digits and the marks of keys, or
whatever stands beside a hint word ("token: x", "password = 'x'", "bearer x"), of any
length and with any marks. "=" and ":" end a candidate, but for base64's padding
and quoted values beside a hint word, so that a key's name is context and not part of it. The
forest looks at its length, character transitions, coverage by dictionary words, path
and address form and neighbouring words on both sides. It is trained from labelled findings: those
of a sample of documents that a rule can label, and made-up ones for shapes that the documents lack.
The dictionary is the sample's frequent words.
"""

from __future__ import annotations

import math
import random
import string
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from typing import NamedTuple

import pyarrow as pa
import regex
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, cut, keep_ids, written

HINTS = r"token|secret|passw|api.?key|auth|credential|bearer|private"
HINT = regex.compile(rf"(?i){HINTS}")
WIDE = regex.compile(r"[A-Za-z0-9_+/.@-]{16,}")
NAME = regex.compile(rf"(?i)(?:{HINTS})[\w-]*(?: keys?\b)?")
#: What may stand between a hint word and a value, and the values: to the end of the quotes, or to the next mark of syntax.
GAP = regex.compile(r"""(?=[\s"'`:=])["'`]?\s*(?:(?:[:=]+>?|(?:is|was|ist|war|est|es|era)(?=\s))\s*)?""")
QUOTED = regex.compile(rf"""(?i)(["'`])(?![^\s"'`]*(?:{HINTS})[^\s"'`=:]*[=:])([^\s"'`]+)\1""")
BARE = regex.compile(r"""["'`]?([^\s"'`,;&=:<>(){}\[\]]+)""")
PADDING = regex.compile(r"""={1,2}(?![^\s"'`,;&<>(){}\[\]])""")
#: Words that made-up names, paths and addresses are made of.
NAMES = ("http", "https", "www", "com", "org", "example", "mail", "user", "home", "path", "file", "index", "html", "test", "data", "config", "service", "function", "class", "value", "name", "version", "license", "copyright")
#: Documents that a model learns from at most, labelled findings of each kind, words of the dictionary and their lengths.
SAMPLE, LABELLED, WORDS, WORD_CHARS = 5_000, 3_000, 20_000, (4, 16)
#: Characters before and after a candidate that count as its context.
CONTEXT = 40
MAIL = regex.compile(r"[^@\s]+@[^@\s]+\.[A-Za-z]{2,}")
KEY = regex.compile(r"(?=.*\d)(?=.*[A-Za-z])[A-Za-z0-9+/_=-]{16,}")
LETTERS = regex.compile(r"\p{L}+")
#: What names a hash, an id or data beside it, which looks like a key and is none.
DIGEST = regex.compile(r"(?i)\b(?:commit|rev|revision|tree|blob|sha-?\d*|md5|crc\d*|checksums?|digest|integrity|etag|hash|uuid|guid|base64|image|png|fingerprint)\b")
UUID = regex.compile(r"(?i)[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}")
#: How keys of well-known services begin.
PREFIXES = ("AKIA", "ghp_", "sk-")
FEATURES = (
    "length", "letter_digit", "case", "mark", "entropy", "digits", "uppers", "hex", "longest_letters", "covered", "slashes", "dots", "mail", "address", "marks",
    "hinted", "assigned", "quoted", "hint_after", "words_before", "words_after", "pairs", "digest_before", "uuid", "prefixed",
)
SCHEMA = "id long, start long, candidate string, " + ", ".join(f"{f} double" for f in FEATURES)


class Model(NamedTuple):
    """A forest, None where it had nothing to learn from, and the dictionary its features use."""

    forest: RandomForestClassificationModel | None
    words: frozenset[str]


def covered(candidate: str, words: frozenset[str]) -> float:
    """The share of a candidate's characters that dictionary words cover, the longest word at each place first."""
    low, at, n = candidate.lower(), 0, 0
    while at < len(low):
        step = next((k for k in range(min(WORD_CHARS[1], len(low) - at), WORD_CHARS[0] - 1, -1) if low[at : at + k] in words), 0)
        n += step
        at += step or 1
    return n / len(candidate)


def known(texts: list[str], words: frozenset[str]) -> float:
    """The share of texts that are dictionary words; short ones don't count."""
    texts = [t.lower() for t in texts if len(t) >= WORD_CHARS[0]]
    return sum(t in words for t in texts) / len(texts) if texts else 0.5


@lru_cache(maxsize=4)
def transitions(words: frozenset[str]) -> dict[str, float]:
    """How likely one letter follows another in dictionary words, as a logarithm, for each pair that occurs."""
    pairs = Counter(a + b for w in (words or frozenset(NAMES)) for a, b in pairwise(w))
    firsts: Counter[str] = Counter()
    for pair, n in pairs.items():
        firsts[pair[0]] += n
    return {pair: math.log(n / firsts[pair[0]]) for pair, n in pairs.items()}


def likelihood(candidate: str, words: frozenset[str]) -> float:
    """The mean logarithm over a candidate's pairs of neighbouring characters; pairs that no word has count as very rare."""
    known_pairs = transitions(words)
    low = candidate.lower()
    return sum(known_pairs.get(a + b, -9.0) for a, b in pairwise(low)) / max(1, len(low) - 1)


def traits(candidate: str, before: str, after: str, words: frozenset[str]) -> tuple[float, ...]:
    """The features of a candidate between the texts before and after it."""
    kind = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in candidate]
    n = len(candidate)
    pairs = Counter(zip(kind, kind[1:], strict=False))
    rate = lambda *of: sum(pairs[x, y] + pairs[y, x] for x, y in of) / max(1, n - 1)
    entropy = -sum(k / n * math.log2(k / n) for k in Counter(candidate).values())
    letters = max((len(x) for x in regex.findall(r"[a-z]+|[A-Z]+", candidate)), default=0)
    tail = before.rstrip()
    return (
        float(min(n, 200)), rate(("l", "d"), ("u", "d")), rate(("l", "u")), rate(("o", "l"), ("o", "u"), ("o", "d")), entropy, kind.count("d") / n, kind.count("u") / n,
        sum(c in "0123456789abcdefABCDEF" for c in candidate) / n, letters / n, covered(candidate, words), candidate.count("/") / n, candidate.count(".") / n,
        float(MAIL.fullmatch(candidate) is not None), float(tail.endswith("//")), sum(not c.isalnum() and c not in "_+/=.:@-" for c in candidate) / n,
        float(bool(HINT.search(before))), float(tail.rstrip("\"'").rstrip()[-1:] in ("=", ":")), float(tail[-1:] in ("\"", "'")), float(bool(HINT.search(after))),
        known(LETTERS.findall(before)[-2:], words), known(LETTERS.findall(after)[:2], words),
        likelihood(candidate, words), float(bool(DIGEST.search(before))), float(UUID.fullmatch(candidate) is not None), float(candidate.startswith(PREFIXES)),
    )


def rule(candidate: str, before: str) -> float | None:
    """A finding's label where the form decides it: 1 for a key that is assigned to a hint word's name, 0 for addresses, paths, plain words and plain numbers."""
    if MAIL.fullmatch(candidate) or candidate.isalpha() or candidate.isdigit() or before.endswith("//") or all(x.isalpha() for x in regex.split(r"[/._-]+", candidate) if x):
        return 0.0
    named = regex.search(rf"""(?i)(?:{HINTS})[\w-]*["']?\s*[:=]\s*["']?$""", before)
    return 1.0 if named and KEY.fullmatch(candidate) else None


def spans(text: str) -> list[tuple[int, int]]:
    """Start and end of every candidate, in order; what stands beside a hint word goes before runs that it overlaps."""
    beside: dict[int, int] = {}
    for name in NAME.finditer(text):
        gap = GAP.match(text, name.end())
        if gap is None:
            continue
        if quoted := QUOTED.match(text, gap.end()):
            start, end = quoted.span(2)
        elif bare := BARE.match(text, gap.end()):
            start, end = bare.start(1), bare.start(1) + len(bare[1].rstrip("."))
            end = padded(text, start, end)
        else:
            continue
        if start < end:
            beside[start] = max(end, beside.get(start, 0))
    found, reached = [], 0
    for start, end in sorted(beside.items()):
        if start >= reached:
            found.append((start, end))
            reached = end
    runs = [(m.start(), padded(text, m.start(), m.end())) for m in WIDE.finditer(text)]
    at, apart = 0, []
    for start, end in runs:
        while at < len(found) and found[at][1] <= start:
            at += 1
        if at == len(found) or found[at][0] >= end:
            apart.append((start, end))
    return sorted(found + apart)


def padded(text: str, start: int, end: int) -> int:
    """The end of a candidate with base64's padding, if it has one."""
    more = PADDING.match(text, end)
    return more.end() if more and (more.end() - start) % 4 == 0 else end


def findings(text: str, words: frozenset[str]) -> list[tuple]:
    """(start, candidate, features) of every candidate of a text."""
    return [(a, text[a:b], *traits(text[a:b], text[max(0, a - CONTEXT) : a], text[b : b + CONTEXT], words)) for a, b in spans(text)]


def candidates(documents: DataFrame, words: frozenset[str] = frozenset(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, start, candidate, features, label) of every candidate in the whole texts; start counts code points from 0, label is the rule's or null.

    Null and empty texts have none; a null or repeated id is passed on, and so are repeated rows' findings.
    """
    shared = documents.sparkSession.sparkContext.broadcast(words)
    schema = f"{SCHEMA}, label double"

    def find(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in schema.split(", ")]
        types = [pa.int64(), pa.int64(), pa.string(), *[pa.float64()] * (len(FEATURES) + 1)]
        for part in parts:
            rows = []
            for doc, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist(), strict=True):
                rows += [(doc, *found, rule(found[1], text[max(0, found[0] - CONTEXT) : found[0]])) for found in findings(text or "", shared.value)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    return documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")).mapInArrow(find, schema)


def labelled_findings(spark: SparkSession, words: frozenset[str] = frozenset(), count: int = 1500, seed: int = 11) -> DataFrame:
    """(features, label): the candidates of made-up texts, for shapes that documents lack; half of the texts hold a secret.

    A run of letters and digits is a secret only beside a hint word, or if it begins as a service's keys do. Hashes,
    UUIDs, checksums, encoded data and identifiers are not, alone or beside what names them.
    """
    rng = random.Random(seed)
    near = sorted(words)[:: max(1, len(words) // 500)] or list(NAMES)
    side = lambda: " ".join(rng.choice(near) for _ in range(2))
    pick = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    word = lambda: rng.choice(NAMES) if rng.random() < 0.3 else pick(string.ascii_lowercase, rng.randint(3, 9))
    prefixed = lambda: rng.choice(PREFIXES) + pick(string.ascii_letters + string.digits, 24)
    secret = (lambda: pick("0123456789abcdef", rng.choice((32, 40, 64))), lambda: pick(string.ascii_letters + string.digits, rng.randint(20, 48)), lambda: pick(string.ascii_letters + string.digits + "+/", 43) + "=", lambda: prefixed())
    # these are only looked for beside a hint word
    short = (
        lambda: pick("0123456789abcdef", rng.randint(8, 15)), lambda: pick(string.ascii_letters + string.digits, rng.randint(8, 15)), lambda: pick(string.ascii_letters, rng.randint(3, 8)) + pick(string.digits, rng.randint(1, 4)) + pick("!$%#*?^~", rng.randint(1, 2)),
        lambda: pick(string.ascii_letters + string.digits + "!$%#*?^~", rng.randint(8, 30)), lambda: pick(string.ascii_letters, 1) + pick(string.ascii_letters + string.digits + "!$%#*?^~", rng.randint(5, 9)) + pick("!$%#*?^~", 1) + pick(string.digits, 1),
    )
    plain = (
        lambda: "/".join(word() for _ in range(rng.randint(3, 6))), lambda: "https://" + ".".join((word(), word(), "com")) + "/" + word(), lambda: pick(string.digits, 16), lambda: word() + "." + word() + "@" + word() + ".example.com",
        lambda: "_".join(word() for _ in range(4)), lambda: pick(string.ascii_lowercase, rng.randint(16, 30)), lambda: "-" * rng.randint(16, 40), lambda: pick(string.ascii_uppercase, rng.randint(16, 30)), lambda: "-".join(word() for _ in range(4)),
    )
    hexes = lambda n: pick("0123456789abcdef", n)
    encoded = lambda n: pick(string.ascii_letters + string.digits + "+/", n)
    uuid = lambda: "-".join(hexes(n) for n in (8, 4, 4, 4, 12))
    camel = lambda: "".join(word().capitalize() for _ in range(rng.randint(3, 5)))
    # texts that hold no secret, though they look it
    alike = (
        lambda: f"{rng.choice(('commit', 'tree', 'rev', 'at', 'of', word()))} {hexes(40)}", lambda: f"{rng.choice(('md5', 'md5 sum', 'checksum', 'MD5:', word()))} {hexes(32)}", lambda: f"sha256:{hexes(64)}", lambda: f"{hexes(rng.choice((32, 40, 64)))}  {word()}.html",
        uuid, lambda: f"{rng.choice(('id', 'uuid', 'request', word()))}={uuid()}", lambda: f"sha512-{encoded(86)}==", lambda: f'"integrity": "sha512-{encoded(86)}=="', lambda: f"data:image/png;base64,iVBORw0KGgo{encoded(rng.randint(60, 200))}",
        lambda: f"base64 {encoded(rng.randint(40, 120))}", lambda: encoded(rng.choice((40, 64, 120))), lambda: f"iVBORw0KGgo{encoded(60)}", camel, lambda: f"the {named()} {camel()}", lambda: f"{named()} is {camel()}", lambda: f"{word()}: {hexes(40)}",
    )
    named = lambda: rng.choice(("token", "api_key", "secret", "password", "auth", "credential", "private_key"))
    beside = (lambda: f'{named()} = "%s"', lambda: f"{named()}: %s", lambda: f"{named()}=%s", lambda: f'"{named()}": "%s"', lambda: f"{named()} is %s", lambda: "bearer %s")
    prose = (word, word, lambda: word().capitalize(), lambda: pick(string.digits, rng.randint(1, 4)), lambda: "".join((word(), rng.choice(",.?!"))), lambda: "--", lambda: rng.choice(("None", "true", "null", "self." + word())))
    rows = []
    for _ in range(count):
        good = rng.random() < 0.5
        if good:
            alone = rng.random() < 0.15
            held = prefixed() if alone else rng.choice((*secret, *short))()
            shape = rng.choice(("%s", f"{word()}=%s", f"{word()}: %s")) if alone else rng.choice(beside)()
        elif rng.random() < 0.5:
            held, shape = "", "%s" + rng.choice(alike)().replace("%", "")
        else:
            held = rng.choice(plain)() if rng.random() < 0.6 else rng.choice(prose)()
            shape = rng.choice((*beside, lambda: f"{named()} %s", lambda: f"{named()} %s"))() if rng.random() < 0.15 or len(held) < 16 else "%s"
        text = f"{side()} {shape % held} {side()}"
        rows += [(*found[2:], float(good and found[1] == held)) for found in findings(text, words)]
    return spark.createDataFrame(rows, ", ".join(f"{f} double" for f in (*FEATURES, "label")))


def _vectors(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(df)


def train(findings: DataFrame, words: frozenset[str] = frozenset(), trees: int = 20, depth: int = 6, seed: int = 5) -> Model:
    """A model from labelled findings (the features and label, 0 or 1); rows with nulls are left out. Without findings of both kinds it has no forest."""
    # the forest goes over its rows many times
    rows = cut(findings.select(*FEATURES, "label").dropna())
    if len(rows.select("label").distinct().limit(2).collect()) < 2:
        return Model(None, words)
    return Model(RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(_vectors(rows)), words)


def dictionary(texts: DataFrame, count: int = WORDS) -> frozenset[str]:
    """The most frequent words of texts(text), of WORD_CHARS letters and found twice at least; ties by the word."""
    words = texts.select(F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).where(F.length("word").between(*WORD_CHARS))
    often = words.groupBy("word").count().where("count > 1").orderBy(F.desc("count"), "word").limit(count)
    return frozenset(r.word for r in often.collect())


def learn(documents: DataFrame, sample: int = SAMPLE, labelled: int = LABELLED, id_column: str = "doc_id", text_column: str = "text") -> Model:
    """A model from at most `sample` documents, those with the smallest hashes of their ids, and from made-up findings.

    The documents give the dictionary and the findings that the rule labels, at most `labelled` of
    each label, again by hashes. Rows with a null id or text are left out.
    """
    spark = documents.sparkSession
    usable = documents.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text")).where("id is not null and text is not null")
    ids = cut(usable.select("id").distinct().orderBy(F.xxhash64("id"), "id").limit(sample))
    texts = written(keep_ids(usable, ids, "id", max(BROADCAST_IDS, sample)), "secret-texts")
    words = dictionary(texts)
    found = written(candidates(texts, words, "id").where("label is not null"), "secret-findings")
    ranked = found.withColumn("_place", F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("id", "start"), "id", "start", "candidate")))
    return train(ranked.where(F.col("_place") <= labelled).select(*FEATURES, "label").unionByName(labelled_findings(spark, words)), words)


def scan(documents: DataFrame, model: Model, least: float = 0.5, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, start, candidate, score): candidates that the forest takes for secrets; without a forest, all of them with score 0.5.

    Texts are read whole, however long. Null and empty ones have no findings; rows that repeat an id are scanned one by one.
    """
    found = candidates(documents, model.words, id_column, text_column)
    if model.forest is None:
        scored = found.withColumn("score", F.lit(0.5))
    else:
        scored = model.forest.transform(_vectors(found)).withColumn("score", vector_to_array("probability")[1])
    return scored.where(F.col("score") >= least).select(F.col("id").alias(id_column), "start", "candidate", "score")
