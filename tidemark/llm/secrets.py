"""Secret scans: fixed patterns plus character Markov models of random strings and identifiers.

Two first-order character models, one of random strings and one of ordinary identifiers, are
counted from labelled samples.  A long token whose log-likelihood ratio favours the random model by
``LEAST_ODDS`` is reported besides the pattern matches.  Everything is DataFrame expressions; only
the two bigram tables (at most 2 * 67 * 67 counts, whatever the input) reach the driver.

Defined results: null and empty texts have no spans; texts of any length are scanned whole; positions
are code points, end exclusive; overlapping matches of different kinds are all kept, a model span
inside a pattern span is not repeated; repeated rows are scanned each; an empty table gives an empty
result; other columns of any name pass through ``redact``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name as _free_name

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/=_-"
#: Fixed values of the pattern kinds, in the order in which ties are listed.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
TOKEN = r"[A-Za-z0-9+/=_-]{16,}"
IDENTIFIER = r"\b[A-Za-z][A-Za-z_-]{11,}"
ASSIGN_LEAST = 12
KINDS = ("assign", "access", "hex", "markov")
#: Log odds and mean log-likelihood ratio per transition that a random token needs, and its distinct characters.
LEAST_ODDS, LEAST_MEAN, LEAST_DISTINCT = 9.2, 0.4, 8
#: Weight of single characters against transitions, in transitions.
PRIOR = 8.0
#: Invented random strings among the labelled samples, so that a corpus without secrets has a model too.
INVENTED = 2048
#: Parts of ordinary identifiers, joined in every way as labelled samples of their own.
VERBS = "get set make read write load store find count merge split parse format update delete create check open close send"
NOUNS = "value table column record number string buffer session window message document request response account index filter header"


def _located(hits: Column, gaps: Column, kind: int, keep=None) -> Column:
    """Spans of matches, from the matches and the text pieces between them."""
    empty = F.array().cast("array<struct<start:int,end:int,kind:int,text:string>>")
    pairs = F.zip_with(hits, F.slice(gaps, F.lit(1), F.size(hits)), lambda h, g: F.struct(h.alias("h"), F.char_length(g).alias("g")))
    start = F.struct(F.lit(0).alias("at"), empty.alias("out"))

    def step(acc: Column, x: Column) -> Column:
        first = acc["at"] + x["g"]
        end = first + F.char_length(x["h"])
        span = F.struct(first.alias("start"), end.alias("end"), F.lit(kind).alias("kind"), x["h"].alias("text"))
        return F.struct(end.alias("at"), F.array_append(acc["out"], span).alias("out"))

    found = F.aggregate(pairs, start, step, lambda acc: acc["out"])
    return F.filter(found, keep) if keep else found


def assigned(match: Column) -> Column:
    """Value of an assignment match."""
    return F.regexp_extract(match, "^" + ASSIGN, 2)


def samples(docs: DataFrame) -> DataFrame:
    """Labelled samples (token, random): pattern values and digests against identifiers of the texts."""
    text = F.col("text")
    labelled = docs.select(
        F.concat(
            F.transform(F.regexp_extract_all(text, F.lit(f"{ACCESS}|{HEX}"), 0), lambda x: F.struct(x.alias("token"), F.lit(True).alias("random"))),
            F.transform(F.regexp_extract_all(text, F.lit(ASSIGN), 2), lambda x: F.struct(x.alias("token"), (F.char_length(x) >= ASSIGN_LEAST).alias("random"))),
            F.transform(F.regexp_extract_all(text, F.lit(IDENTIFIER), 0), lambda x: F.struct(x.alias("token"), F.lit(False).alias("random"))),
        ).alias("s")
    ).select(F.inline("s"))
    digest = F.sha2(F.col("id").cast("string").cast("binary"), 256)
    invented = docs.sparkSession.range(INVENTED).select(
        F.when(F.col("id") % 2 == 0, F.base64(F.unhex(digest))).otherwise(F.upper(F.substring(digest, 1, 32))).alias("token"), F.lit(True).alias("random")
    )
    verbs, nouns = (F.explode(F.split(F.lit(x), " ")) for x in (VERBS, NOUNS))
    parts = docs.sparkSession.range(1).select(verbs.alias("v")).select("v", nouns.alias("n"))
    ordinary = parts.select(F.explode(F.array(F.concat_ws("_", "v", "n"), F.concat("v", F.initcap("n")), F.concat_ws("-", "n", "v"))).alias("token"), F.lit(False).alias("random"))
    return labelled.unionByName(invented).unionByName(ordinary)


def _codes(token: Column) -> Column:
    """Codes of neighbouring characters; tokens of one character or none have no neighbours."""
    at = F.transform(F.split(token, ""), lambda c: F.call_function("instr", F.lit(ALPHABET), c) - 1)
    n = F.size(at)
    pairs = F.zip_with(F.slice(at, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(at, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.when((a >= 0) & (b >= 0), a * len(ALPHABET) + b))
    return F.filter(pairs, lambda p: p.isNotNull())


def train(labelled: DataFrame) -> list[float]:
    """Log-likelihood ratio of each transition, smoothed towards the single characters; position a * 67 + b. A sample counts a transition once."""
    n = len(ALPHABET)
    counts = {True: [0] * (n * n), False: [0] * (n * n)}
    table = labelled.select("random", F.explode(F.array_distinct(_codes(F.col("token")))).alias("code")).groupBy("random", "code").count()
    for r in table.where("random is not null").collect():  # at most 2 * 67 * 67 rows
        counts[r["random"]][r["code"]] = r["count"]
    out = []
    single = {k: [1 + sum(v[a * n + b] for a in range(n)) for b in range(n)] for k, v in counts.items()}
    for a in range(n):
        log: dict[bool, list[float]] = {}
        for k, v in counts.items():
            row, whole = v[a * n : a * n + n], sum(single[k])
            log[k] = [math.log((row[b] + PRIOR * single[k][b] / whole) / (sum(row) + PRIOR)) for b in range(n)]
        out += [x - y for x, y in zip(log[True], log[False], strict=True)]
    return out


def with_spans(docs: DataFrame, ratios: list[float], name: str = "__spans") -> DataFrame:
    """The rows with one more column: array of (start, end, kind, text), by start, kind and end."""
    text = F.coalesce(F.col("text"), F.lit(""))
    names = [_free_name(docs, f"__{k}") for k in KINDS]
    patterns = (ASSIGN, ACCESS, HEX, TOKEN)
    rows = docs.select("*", *[F.regexp_extract_all(text, F.lit(p), 0).alias(c) for p, c in zip(patterns, names, strict=True)])
    table = F.expr("array(" + ",".join(f"{x!r}D" for x in ratios) + ")")

    def random(s: Column) -> Column:
        codes = _codes(s["text"])
        total = F.aggregate(codes, F.lit(0.0), lambda acc, c: acc + F.get(table, c))
        return (F.size(F.array_distinct(F.split(s["text"], ""))) >= LEAST_DISTINCT) & (total >= F.greatest(F.lit(LEAST_ODDS), LEAST_MEAN * F.size(codes)))

    keeps = (lambda s: F.char_length(assigned(s["text"])) >= ASSIGN_LEAST, None, None, random)
    none = F.array().cast("array<struct<start:int,end:int,kind:int,text:string>>")
    found = rows.select(
        *[F.col(f"`{c}`") for c in docs.columns],
        *[
            F.when(F.size(c) == 0, none).otherwise(_located(F.col(c), F.split(text, p, -1), k, keep)).alias(c)
            for k, (p, c, keep) in enumerate(zip(patterns, names, keeps, strict=True))
        ],
    )
    base, more = F.concat(*names[:3]), F.col(names[3])
    outside = F.filter(more, lambda m: ~F.exists(base, lambda b: (b["start"] <= m["start"]) & (b["end"] >= m["end"])))
    spans = F.array_sort(
        F.transform(F.concat(base, outside), lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"), s["text"].alias("text")))
    )
    return found.select(*[F.col(f"`{c}`") for c in docs.columns], spans.alias(name))


def listed(spans: Column) -> Column:
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def scan(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of the spans of every text, by models trained on these documents."""
    found = with_spans(docs.select("doc_id", "text"), train(samples(docs)))
    spans = F.col("__spans")
    of = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        of(0).alias("n_assign"),
        of(1).alias("n_access"),
        of(2).alias("n_hex"),
        F.sha2(listed(F.filter(spans, lambda s: s["kind"] < 3)).cast("binary"), 256).alias("base_sha256"),
        listed(spans).alias("spans"),
    )


def redact(docs: DataFrame, ratios: list[float], mark: str = "[SECRET]") -> DataFrame:
    """The same columns, secrets in ``text`` replaced by a mark; null texts stay null."""
    text = F.col("text")
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        new = s["start"] >= acc["at"]
        out = F.when(new, F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), out.alias("out"))

    name = _free_name(docs, "__spans")
    clean = F.aggregate(F.col(name), begin, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))))
    rows = with_spans(docs, ratios, name)
    return rows.select(*[F.when(F.size(name) == 0, text).otherwise(clean).alias(c) if c == "text" else F.col(f"`{c}`") for c in docs.columns])
