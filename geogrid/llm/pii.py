"""Personal data: candidate spans, boosted trees over format and context, calibrated thresholds.

Generators of high recall propose spans, which may overlap. The base kinds (email, ip, card, phone)
are decided by their rules. All other candidates (secrets and loose numbers) are scored by
gradient-boosted trees over binned features of format and context; a kind's threshold is the lowest
score at which ``PRECISION`` of the accepted calibration candidates are right (``FALLBACK`` if none is).

There are no labels for spans, so the truth is planted: examples of personal data and of harmless
look-alikes, made from hashes, are put with varied or no introductions into snippets of
``SAMPLE`` documents, and the generators run over these texts. A candidate's label is what was planted
where it stands, whatever its features say. The number of examples does not depend on the input.
The driver sees one row for each combination of bins.

All of it is DataFrame functions: spans are found by splitting a text at a pattern and adding up
lengths, and a model is one Column expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("secret", "number")
#: Generators of the added kinds.
GENERATORS = {"token": "secret", "hex": "secret", "assigned": "secret", "digits": "number", "grouped": "number"}
KINDS = (*BASE, *GENERATORS)
#: Spans that generators propose. Possessive repeats and starts at the edge of a run match what the
#: plain patterns match, in linear time and without recursion.
_LOCAL, _TOKEN = "A-Za-z0-9._%+-", "A-Za-z0-9_+/-"
PATTERNS = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "token": rf"(?<![{_TOKEN}])(?=[{_TOKEN}]*[0-9])(?=[{_TOKEN}]*[A-Za-z])[{_TOKEN}]{{16,}}+",
    "hex": r"(?<![0-9A-Za-z])(?=[0-9A-Fa-f]*[0-9])[0-9A-Fa-f]{16,}+(?![0-9A-Za-z])",
    "assigned": r"(?<=[A-Za-z][\x20]{0,1}[=:][\x20]{0,1}[\"']{0,1})(?=[^\s\"'=:,;]*[0-9])(?=[^\s\"'=:,;]*[A-Za-z])[^\s\"'=:,;]{8,}+",
    "digits": r"(?<![0-9.+])[(0-9](?:[\x20().-]?[0-9]){7,}+(?![0-9])",
    "grouped": r"(?<![0-9A-Za-z+-])[0-9]{3}[\x20-][0-9]{2,4}[\x20-][0-9]{4}(?![0-9-])",
}
#: What a text must hold for a pattern to be tried.
_NEEDED = {"email": "@", "phone": r"\+", "assigned": "[=:]"}
KEYWORDS = r"(?i)(?:pass(?:word|wd|phrase)?|token|secret|credential|private|api[_-]?key|key|auth|bearer|tel|phone|mobile|fax|call|ssn|iban|account)[\x20\"':=]{0,4}(?:is\x20|no\.?\x20)?[\"']?$"
HARMLESS = r"(?i)(?:commit|revision|sha-?1?|sha256|md5|checksum|digest|version|build|isbn|page|section|chapter|figure|total|order|year|on|at|from|see|file|img|href|https?|www)[\x20\"':=#/._-]{0,4}$"
CONTEXT, PRECISION, FALLBACK, ROUNDS, RATE, DEPTH = 24, 0.97, 0.5, 40, 0.3, 3
#: Bounds of the fit: documents whose snippets carry examples, characters of a snippet, and examples.
SAMPLE, SNIPPET, EXAMPLES = 2048, 160, 6144
FEATURES = ("kind", "length", "digits", "upper", "separators", "variety", "word", "hexadecimal", "keyword", "harmless", "assigned", "edge")

SPAN = "struct<kind:int,start:int,end:int,text:string,before:string,after:string>"


def _luhn(digits: Column) -> Column:
    padded = F.lpad(digits, 20, "0")
    total = F.lit(0)
    for i in range(20):  # from the right: every second digit doubled, 9 taken off above 9
        d = F.ascii(F.substring(padded, 20 - i, 1)) - 48
        total = total + (d if i % 2 == 0 else F.when(d > 4, d * 2 - 9).otherwise(d * 2))
    return total % 10 == 0


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _valid(kind: str, text: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(text, r"\."), lambda p: F.regexp_like(p, F.lit(r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$")))
    if kind == "card":
        digits = _digits(text)
        return F.when(F.length(digits).between(12, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(_digits(text)).between(9, 15)
    return F.lit(True)


def _let(value: Column, use) -> Column:
    """``use(value)``, with ``value`` computed once however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def find_spans(text: Column, kind: str) -> Column:
    """All matches of a generator as array of SPAN, leftmost and non-overlapping; offsets in code points.

    Offsets are running sums of lengths, taken in about sqrt(n) blocks of sqrt(n) matches, so n matches
    copy n * sqrt(n) references at most.
    """
    pattern, number = PATTERNS[kind], KINDS.index(kind)
    none = F.array().cast(f"array<{SPAN}>")
    length = lambda p: F.length(p["gap"]) + F.length(p["match"])

    def spans_from(block: Column, at: Column) -> Column:
        def step(acc: Column, p: Column) -> Column:
            start = acc["at"] + F.length(p["gap"])
            end = start + F.length(p["match"])
            span = F.struct(F.lit(number).alias("kind"), start.alias("start"), end.alias("end"), p["match"].alias("text"), F.substring(p["gap"], -CONTEXT, CONTEXT).alias("before"), F.substring(p["next"], 1, 1).alias("after"))
            return F.struct(F.concat(acc["spans"], F.array(span.cast(SPAN))).alias("spans"), end.alias("at"))

        return F.aggregate(block, F.struct(none.alias("spans"), at.cast("int").alias("at")), step, lambda acc: acc["spans"])

    def placed(blocks: Column) -> Column:
        # The offset before each block, and one more after the last.
        offsets = F.aggregate(blocks, F.array(F.lit(0)), lambda acc, b: F.concat(acc, F.array(F.element_at(acc, -1) + F.aggregate(b, F.lit(0), lambda t, p: t + length(p)))))
        return F.flatten(F.zip_with(blocks, F.slice(offsets, 1, F.size(blocks)), spans_from))

    def blocked(pairs: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(pairs))).cast("int")
        return _let(F.transform(F.sequence(F.lit(1), F.size(pairs), size), lambda i: F.slice(pairs, i, size)), placed)

    def paired(m: Column) -> Column:
        n = F.size(m["found"])
        around = F.arrays_zip(F.slice(m["gaps"], 1, n).alias("gap"), F.slice(m["gaps"], 2, n).alias("next"))
        pairs = F.zip_with(around, m["found"], lambda g, x: F.struct(g["gap"].alias("gap"), g["next"].alias("next"), x.alias("match")))
        return F.when(n > 0, _let(pairs, blocked)).otherwise(none)

    spans = _let(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("gaps")), paired)
    # All spans but an email's hold a digit.
    some = F.regexp_like(text, F.lit(_NEEDED[kind])) if kind in _NEEDED else F.lit(True)
    some = some if kind == "email" else F.regexp_like(text, F.lit("[0-9]")) & some
    return F.when(some, spans).otherwise(none)


def _valid_spans(text: Column, kind: str) -> Column:
    return F.filter(find_spans(text, kind), lambda s: _valid(kind, s["text"]))


def _binned(x: Column, edges: tuple[float, ...]) -> Column:
    out = F.lit(len(edges))
    for k, e in reversed(list(enumerate(edges))):
        out = F.when(x <= e, F.lit(k)).otherwise(out)
    return out


def span_features(s: Column) -> dict[str, Column]:
    """Binned format and context features of a candidate."""
    text, before = s["text"], s["before"]
    size = F.greatest(F.length(text), F.lit(1))
    share = lambda pattern: F.length(F.regexp_replace(text, pattern, "")) / size
    runs = F.transform(F.regexp_extract_all(text, F.lit("[A-Za-z]+"), F.lit(0)), F.length)
    return {
        "kind": s["kind"],
        "length": _binned(size, (9, 11, 15, 19, 24, 31, 40, 64)),
        "digits": _binned(share("[^0-9]"), (0.0, 0.15, 0.3, 0.5, 0.75, 0.9, 0.999)),
        "upper": _binned(share("[^A-Z]"), (0.0, 0.1, 0.3, 0.6)),
        "separators": _binned(F.length(F.regexp_replace(text, "[A-Za-z0-9]", "")), (0, 1, 2, 4)),
        "variety": _binned(F.size(F.array_distinct(F.split(text, ""))) / size, (0.2, 0.35, 0.5, 0.7)),
        "word": _binned(F.coalesce(F.array_max(runs), F.lit(0)), (0, 2, 3, 4, 6)),
        "hexadecimal": F.regexp_like(text, F.lit("^(?:[0-9a-f]+|[0-9A-F]+)$")).cast("int"),
        "keyword": F.regexp_like(before, F.lit(KEYWORDS)).cast("int"),
        "harmless": F.regexp_like(before, F.lit(HARMLESS)).cast("int"),
        "assigned": F.regexp_like(before, F.lit(r"[=:]\s*[\"']?$")).cast("int"),
        "edge": F.regexp_like(F.concat(F.substring(before, -1, 1), s["after"]), F.lit("[A-Za-z0-9]")).cast("int"),
    }


def _pick(n: Column, salt: int, options: list[Column]) -> Column:
    return F.element_at(F.array(*options), (F.pmod(F.xxhash64(n, F.lit(salt)), F.lit(len(options))) + 1).cast("int"))


def planted_examples(n: Column) -> Column:
    """struct(kind, label, lead, span, tail) number ``n``: personal data (label 1) or a look-alike (0)."""
    hexes = F.concat(F.sha2(F.concat(n.cast("string"), F.lit(":a")), 256), F.sha2(F.concat(n.cast("string"), F.lit(":b")), 256))
    digits = F.translate(hexes, "abcdef", "135790")
    letters = F.regexp_replace(F.base64(F.unhex(hexes)), "[^A-Za-z0-9]", "")
    part = lambda c, start, size: F.substring(c, start, size)
    d = lambda start, size: part(digits, start, size)
    text = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x for x in xs])
    word = lambda salt: _pick(n, salt, [F.lit(w) for w in ("report", "section", "value", "final", "annual", "user", "profile", "draft", "region", "north", "paper", "model")])
    secrets = [part(hexes, 1, 40), part(hexes, 3, 32), part(hexes, 2, 64), part(hexes, 5, 24), F.upper(part(hexes, 1, 32)), text("AKIA", F.upper(part(letters, 1, 16))), text("ghp_", part(letters, 1, 36)), part(letters, 4, 24), part(letters, 2, 40), text(part(letters, 1, 20), "_", part(letters, 30, 18)), text(part(hexes, 1, 8), "-", part(hexes, 9, 4), "-", part(hexes, 13, 4), "-", part(hexes, 17, 4), "-", part(hexes, 21, 12))]
    phrases = [part(letters, 1, 10), part(letters, 7, 14), text(part(letters, 3, 6), "!", part(letters, 11, 5), "7")]
    numbers = [text("(", d(1, 3), ") ", d(4, 3), "-", d(7, 4)), text(d(1, 3), "-", d(4, 3), "-", d(7, 4)), text(d(1, 3), "-", d(4, 2), "-", d(6, 4)), text(d(1, 3), " ", d(4, 3), " ", d(7, 4)), text(d(1, 4), " ", d(5, 4), " ", d(9, 3)), d(2, 10), d(5, 12)]
    year = text(_pick(n, 21, [F.lit("19"), F.lit("20")]), d(3, 2))
    month, day = _pick(n, 22, [F.lit(x) for x in ("01", "04", "07", "10", "12")]), _pick(n, 23, [F.lit(x) for x in ("02", "11", "19", "28")])
    tokens = [text(word(31), "-", d(1, 2), "-", word(32), "-", d(4, 2)), text(word(31), "_", word(32), "_", year, "_", word(33)), text(word(31), "/", year, "/", month, "/", word(32), "-", word(33)), text("IMG_", year, month, day, "_", d(7, 6)), text(word(31), F.initcap(word(32)), year, F.initcap(word(33))), text(word(31), "+", word(32), d(1, 3), "+", word(33)), text(F.repeat(part(hexes, 1, 1), 12), F.repeat(d(2, 1), 8)), text(word(31), "1234567890", word(32))]
    figures = [text(year, "-", month, "-", day), text(year, month, day), text(year, "-", month, "-", day, " ", d(1, 2)), text(d(1, 1), "000000000"), text("978-", d(1, 1), "-", d(2, 2), "-", d(4, 6), "-", d(10, 1)), text(year, " ", year, " ", year), text(d(1, 3), ".", d(4, 3), ".", d(7, 3)), "123456789", F.repeat(d(1, 1), 10), text(year, "-", year)]
    figures = [F.lit(x) if isinstance(x, str) else x for x in figures]
    lead = lambda salt, *xs: _pick(n, salt, [F.lit(x) for x in xs])
    row = lambda kind, label, before, span, after="": F.struct(F.lit(kind).alias("kind"), F.lit(label).alias("label"), before.alias("lead"), span.alias("span"), F.when(F.substring(before, -1, 1).isin('"', "'"), F.substring(before, -1, 1)).otherwise(F.lit(after)).alias("tail"))
    return _pick(n, 1, [
        row("secret", 1, lead(2, 'token = "', "password=", "api_key: ", "secret = ", 'key = "', "Bearer ", "the token is ", "credential '"), _pick(n, 3, secrets)),
        row("secret", 1, lead(2, "", "", "", "login ", "with ", "("), _pick(n, 4, secrets)),
        row("secret", 1, lead(5, "password=", "password: ", 'passwd = "', "secret: ", "auth: '"), _pick(n, 6, phrases)),
        row("number", 1, lead(7, "call ", "phone: ", "tel ", "mobile ", "fax: ", "ssn ", "account ", "account no. "), _pick(n, 8, numbers)),
        row("number", 1, lead(7, "", "", "reach me at ", "or "), _pick(n, 9, numbers[:5])),
        row("secret", 0, lead(10, "", "", "see ", "file ", "https://example.org/", "in ", "and "), _pick(n, 11, tokens)),
        row("secret", 0, lead(12, "commit ", "sha1 ", "md5: ", "checksum ", "revision ", "sha256=", "digest: "), _pick(n, 13, secrets[:4])),
        row("secret", 0, lead(10, "name: ", "title = ", "href=", "class: ", "path = "), _pick(n, 14, tokens)),
        row("number", 0, lead(15, "", "", "on ", "from ", "total ", "order ", "page ", "isbn ", "version ", "year "), _pick(n, 16, figures)),
        row("number", 0, lead(17, "", "order ", "total ", "item ", "figure ", "build "), _pick(n, 18, [d(2, 8), d(2, 9), d(3, 11)])),
    ])


@dataclass
class Trees:
    """Boosted trees: (feature, bin, left, right) with a leaf or another such split on each side."""

    bias: float = 0.0
    trees: list = field(default_factory=list)
    #: Least score of each added kind; a kind without one is never accepted.
    thresholds: dict[str, float] = field(default_factory=dict)

    def score(self, f: Column) -> Column:
        """Probability of a candidate with the features ``f`` (a struct)."""

        def column(node) -> Column:
            if isinstance(node, float):
                return F.lit(node)
            name, edge, left, right = node
            return F.when(f[name] <= edge, column(left)).otherwise(column(right))

        out = F.lit(self.bias)
        for t in self.trees:
            out = out + column(t)
        return F.lit(1.0) / (F.exp(-out) + 1)

    def accepted(self, candidates: Column) -> Column:
        """The candidates (array of SPAN) that reach their kind's threshold."""
        if not self.trees:
            return F.filter(candidates, lambda s: F.lit(False))
        limits = F.array(*[F.lit(float(self.thresholds.get(k, 2.0))) for k in GENERATORS.values()])
        scored = F.transform(candidates, lambda s: F.struct(s.alias("s"), F.struct(*[v.alias(k) for k, v in span_features(s).items()]).alias("f")))
        kept = F.filter(scored, lambda x: self.score(x["f"]) >= F.get(limits, x["s"]["kind"] - len(BASE)))
        return F.transform(kept, lambda x: x["s"])


def _value(node, row: dict) -> float:
    while not isinstance(node, float):
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return node


def _grow(rows: list[tuple[dict, float, float]], depth: int):
    """A tree by the largest gain of the second-order loss; rows: (bins, gradient, hessian)."""
    g, h = sum(r[1] for r in rows), sum(r[2] for r in rows)
    best = (1e-6, None)
    if depth:
        for name in FEATURES:
            bins: dict[int, list[float]] = {}
            for r in rows:
                own = bins.setdefault(r[0][name], [0.0, 0.0])
                own[0] += r[1]
                own[1] += r[2]
            gl = hl = 0.0
            for edge in sorted(bins)[:-1]:
                gl, hl = gl + bins[edge][0], hl + bins[edge][1]
                gain = gl * gl / (hl + 1) + (g - gl) ** 2 / (h - hl + 1) - g * g / (h + 1)
                best = max(best, (gain, (name, edge)), key=lambda x: x[0])
    if best[1] is None:
        return float(-RATE * g / (h + 1))
    name, edge = best[1]
    return (name, edge, _grow([r for r in rows if r[0][name] <= edge], depth - 1), _grow([r for r in rows if r[0][name] > edge], depth - 1))


def boost(cells: list[dict]) -> Trees:
    """Trees from counted cells: bins, ``half`` (0 fit, 1 calibrate), ``n`` and ``ones``."""
    fit, check = ([c for c in cells if c["half"] == k] for k in (0, 1))
    n, ones = sum(c["n"] for c in fit), sum(c["ones"] for c in fit)
    if not n:
        return Trees()
    bias = math.log((ones + 1) / (n - ones + 1))
    margins, trees = [bias] * len(fit), []
    for _ in range(ROUNDS):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        tree = _grow([(c, q * c["n"] - c["ones"], q * (1 - q) * c["n"]) for c, q in zip(fit, p, strict=True)], DEPTH)
        trees.append(tree)
        margins = [m + _value(tree, c) for m, c in zip(margins, fit, strict=True)]
    thresholds: dict[str, float] = {}
    for name in ADDED:
        own = [c for c in check if GENERATORS[KINDS[c["kind"]]] == name]
        scored = sorted(((1 / (1 + math.exp(-bias - sum(_value(t, c) for t in trees))), c) for c in own), key=lambda x: -x[0])
        total = good = 0
        thresholds[name] = FALLBACK
        for i, (p, c) in enumerate(scored):
            total, good = total + c["n"], good + c["ones"]
            last = i + 1 == len(scored) or scored[i + 1][0] < p
            if last and good >= PRECISION * total and p >= 0.1:
                thresholds[name] = p - 1e-9
    return Trees(bias, trees, thresholds)


def _candidates(text: Column) -> Column:
    return F.concat(*[find_spans(text, k) for k in GENERATORS])


def training_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(half, text, kind, label, start, end): ``EXAMPLES`` planted examples in snippets of at most ``SAMPLE`` documents,
    the first by a hash of id and snippet."""
    text, h = F.coalesce(F.col(text_col), F.lit("")), F.xxhash64(F.col(id_col), F.lit(5))
    at = F.pmod(h, F.greatest(F.length(text) - SNIPPET, F.lit(1)).cast("long")).cast("int") + 1
    snippets = docs.select(h.alias("h"), F.substring(text, at, F.lit(SNIPPET)).alias("snippet"))
    chosen = snippets.orderBy("h", "snippet").limit(SAMPLE)
    # At most SAMPLE rows pass these windows.
    numbered = chosen.withColumn("number", F.row_number().over(Window.orderBy("h", "snippet")) - 1).withColumn("total", F.count("*").over(Window.partitionBy()))
    copies = F.sequence(F.lit(0), F.ceil(F.lit(EXAMPLES) / F.col("total")).cast("int") - 1)
    rows = numbered.select("snippet", F.explode(copies).alias("copy"), "number", "total").withColumn("n", F.col("copy") * F.col("total") + F.col("number")).withColumn("e", planted_examples(F.col("n")))
    rows = rows.repartition("n")
    left = F.concat(F.substring("snippet", 1, SNIPPET // 2), F.lit(" "), F.col("e.lead"))
    whole = F.concat(left, F.col("e.span"), F.col("e.tail"), F.lit(" "), F.substring("snippet", SNIPPET // 2 + 1, SNIPPET))
    return rows.select((F.pmod(F.xxhash64("n", F.lit(7)), F.lit(2))).cast("int").alias("half"), whole.alias("text"), F.col("e.kind").alias("kind"), F.col("e.label").alias("label"), F.length(left).alias("start"), (F.length(left) + F.length("e.span")).alias("end"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Trees:
    """Trees from planted examples in snippets of ``docs``; without any document there are no trees."""
    rows = training_texts(docs, id_col, text_col).select("half", F.col("label").alias("planted"), F.col("start").alias("a"), F.col("end").alias("z"), F.explode(_candidates(F.col("text"))).alias("s"))
    both = F.least("z", F.col("s.end")) - F.greatest("a", F.col("s.start"))
    # A candidate with less than half of what was planted is no find; one that misses it is unknown.
    label = F.when(both * 2 >= F.col("z") - F.col("a"), F.col("planted")).when(both > 0, F.lit(0))
    bins = {k: v.cast("int").alias(k) for k, v in span_features(F.col("s")).items()}
    labelled = rows.select("half", *bins.values(), label.alias("label")).where(F.col("label").isNotNull())
    cells = labelled.groupBy("half", *FEATURES).agg(F.count("*").alias("n"), F.sum("label").alias("ones"))
    return boost(sorted((r.asDict() for r in cells.collect()), key=lambda c: tuple(c.values())))


def _named(s: Column) -> Column:
    """(start, kind, end), the kind numbered as in BASE + ADDED."""
    kind = F.get(F.array(*[F.lit((*BASE, *ADDED).index(GENERATORS.get(k, k))) for k in KINDS]), s["kind"])
    return F.struct(s["start"].alias("start"), kind.alias("kind"), s["end"].alias("end"))


def redactions(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = (), name: str = "spans") -> DataFrame:
    """``id_col``, ``spans`` (array of start, kind number, end; sorted), for each row.

    Base kinds pass their rules; added kinds pass the trees' threshold and overlap no base span, but
    may overlap each other. Null and empty texts have no spans. ``carry`` names input columns to keep.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = F.concat(*[_valid_spans(text, k) for k in BASE])
    rows = docs.select(F.col(id_col).alias("__id"), base.alias("__base"), _candidates(text).alias("__more"), *(F.col(f"`{c}`").alias(f"__{i}") for i, c in enumerate(carry)))
    more = F.filter(model.accepted(F.col("__more")), lambda s: ~F.exists("__base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    found = F.concat("__base", F.when(F.size("__more") > 0, more).otherwise(F.col("__more")))
    spans = F.array_sort(F.array_distinct(F.transform(found, _named)))
    return rows.select(F.col("__id").alias(id_col), spans.alias(name), *(F.col(f"__{i}").alias(c) for i, c in enumerate(carry) if c != id_col))


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == (*BASE, *ADDED).index(kind))).cast("long")


def span_text(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, (*BASE, *ADDED)))
    return F.array_join(F.transform(spans, lambda s: F.concat(F.element_at(names, s["kind"] + 1), F.lit(":"), s["start"], F.lit(":"), s["end"])), ",")


def redact(docs: DataFrame, model: Trees, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, each span's text replaced by its kind in brackets; of
    overlapping spans the part not yet covered is dropped with the earlier one. Null texts stay null."""
    names = F.array(*map(F.lit, (*BASE, *ADDED)))
    own = "__found"
    while own in docs.columns:
        own += "_"
    found = redactions(docs, model, id_col, text_col, carry=tuple(docs.columns), name=own)
    text = F.col(text_col)
    start = F.struct(F.array().cast("array<string>").alias("out"), F.lit(0).alias("at"))

    def step(acc: Column, s: Column) -> Column:
        kept = F.substring(text, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
        label = F.when(s["start"] >= acc["at"], F.concat(F.lit("["), F.element_at(names, s["kind"] + 1), F.lit("]"))).otherwise("")
        return F.struct(F.concat(acc["out"], F.array(F.concat(kept, label))).alias("out"), F.greatest(acc["at"], s["end"]).alias("at"))

    done = F.aggregate(own, start, step, lambda acc: F.concat(F.array_join(acc["out"], ""), F.substring(text, acc["at"] + 1, F.length(text))))
    cleaned = F.when(F.size(own) > 0, done).otherwise(text)
    return found.select(*[cleaned.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
