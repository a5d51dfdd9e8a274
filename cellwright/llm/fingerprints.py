"""Document fingerprints by consistent weighted sampling.

A text's terms are its words (lower-cased, maximal runs of characters other
than ASCII white space), weighted by how often they occur. Sample k of a text
takes, for each term with weight S, from hashes of (term, k) alone

    r, c ~ Gamma(2, 1),  b ~ U(0, 1)
    t = floor(ln S / r + b),   ln a = ln c - r (t - b + 1)

and keeps the term and t of the smallest a. Two texts agree in a sample with
probability sum(min S) / sum(max S), their generalised Jaccard similarity. A
signature stores one 32-bit hash of (term, t) per sample.

All of it is column expressions: words are hashed and sorted inside their row,
equal neighbours become weights, the terms are exploded, and each sample is one
minimum over a long (ln a in the high bits, the hash in the low ones), combined
in the task that read the text, before anything moves. Two texts of one row are taken together: a
term that both hold equally often is sampled once for both. Samples are independent, so
the likeness of two texts of similarity s has variance s (1 - s) / SAMPLES.

Defined results
    null or empty text       no terms: every sample is empty (zeros); such texts
                             are alike with likeness 1, and unlike others
    one document             its own next document
    equal doc_ids            followed by one another, ordered by text hash
    repeated rows            each is returned
    empty table              no rows
    other columns            kept out; doc_id and text are read
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..operators.positions import number_rows
from ..session import store

SAMPLES = 64
_LOW = (1 << 32) - 1


def _uniform(bits: str, width: int) -> str:
    return f"(({bits}) + 0.5D) * {2.0**-width!r}D"


def _sample(k: int) -> Column:
    """ln a of one sample as fixed point in the high half of a long, a hash of (term, t) in the low half.

    Two hashes of (_term, k) give r, c and b of this sample alone. Written as one
    SQL text, as building so many columns one call at a time takes longer than small inputs.
    """
    bits, more = f"xxhash64(_term, {k})", f"xxhash64(_term, {-1 - k})"
    u = _uniform(f"shiftrightunsigned({bits}, 43)", 21)
    v = _uniform(f"shiftrightunsigned({bits}, 22) & {(1 << 21) - 1}L", 21)
    b = _uniform(f"{bits} & {(1 << 22) - 1}L", 22)
    r = f"(-ln({_uniform(f'shiftrightunsigned({more}, 32)', 32)} * {_uniform(f'{more} & {_LOW}L', 32)}))"
    t = f"floor(_lnw / {r} + {b})"
    log_a = f"ln(-ln({u} * {v})) - {r} * ({t} - {b} + 1.0D)"
    # ln a lies between about -120 and 4
    high = f"floor(({log_a} + 1000.0D) * {float(1 << 20)!r}D)"
    name = f"({bits} ^ ({t} * {(1 << 21) + (1 << 8)}L))"
    return F.expr(f"shiftleft({high}, 32) | ({name} & {_LOW}L)")


def _word_marks(column: str, side: int) -> Column:
    """Hashes of the words of a text; the lowest bit tells the text."""
    words = F.split(F.lower(F.coalesce(F.col(column), F.lit(""))), "[\\x20\\x09-\\x0D]+")
    return F.transform(
        F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w).bitwiseAND(F.lit(-2)).bitwiseOR(F.lit(side))
    )


def _term_rows(texts: DataFrame, key: list[str], columns: list[str]) -> DataFrame:
    """key, _term, _lnw, _in: the terms of one or two texts of each row.

    ``_in`` has bit 1 for the first text and bit 2 for the second. A term that both hold
    equally often is one row, so it is sampled once. A row without words has one row of NULLs.
    """
    marks = [_word_marks(c, side) for side, c in enumerate(columns)]
    hashed = texts.select(*key, F.sort_array(F.concat(*marks)).alias("_w"))
    last = F.transform(
        "_w", lambda x, i: F.when(F.coalesce(F.get("_w", i + 1) != x, F.lit(True)), i + 1)
    )
    ends = hashed.select(*key, "_w", F.array_compact(last).alias("_ends"))
    rows = ends.select(*key, "_w", "_ends", F.posexplode_outer("_ends").alias("_j", "_end"))
    end = lambda j: F.coalesce(F.get("_ends", j), F.lit(0))
    j, word = F.col("_j"), F.get("_w", F.col("_end") - 1)
    second = word.bitwiseAND(F.lit(1)) == 1
    # the same term in the other text stands just before (first text) or after (second text)
    before = F.when(F.get("_w", end(j - 1) - 1).bitwiseOR(F.lit(1)) == word, end(j - 1) - end(j - 2))
    after = F.when(F.get("_w", F.col("_end")) == word.bitwiseOR(F.lit(1)), end(j + 1) - F.col("_end"))
    weight = F.col("_end") - end(j - 1)
    found = rows.select(
        *key, word.bitwiseAND(F.lit(-2)).alias("_term"), weight.alias("_n"),
        F.when(second & (before == weight), F.lit(0)).when(second, F.lit(2)).when(after == weight, F.lit(3)).otherwise(F.lit(1)).alias("_in"),
    ) if len(columns) > 1 else rows.select(*key, word.bitwiseAND(F.lit(-2)).alias("_term"), weight.alias("_n"), F.lit(1).alias("_in"))
    return found.where("_in > 0").select(*key, "_term", F.ln("_n").alias("_lnw"), "_in")


def signatures(texts: DataFrame, key: list[str], columns=("text",), samples: int = SAMPLES) -> DataFrame:
    """``key`` and a signature (array of ``samples`` longs below 2^32) for each of one or two text columns.

    They are called signature and edited_signature; ``key`` must be unique. A row's terms are exploded and
    combined in the task that holds the row.
    """
    terms = _term_rows(texts, key, list(columns))
    # a row without words has no weight, so its samples are NULL; under a CASE the hashes and logarithms that a
    # sample names several times would be computed each time
    best = [F.min(_sample(k)).alias(f"_s{k}") for k in range(samples)]
    found = terms.groupBy(*key, "_in").agg(*best)
    names = ("signature", "edited_signature")[: len(columns)]
    # a text's minima are those of its own terms and of the terms that both hold
    mine = {n: F.col("_in").isin(bit, 3) for n, bit in zip(names, (1, 2))}
    least = [F.min(F.when(of, F.col(f"_s{k}"))).alias(f"{n}{k}") for n, of in mine.items() for k in range(samples)]
    whole = found.groupBy(*key).agg(*least)
    return whole.select(
        *key, *[F.array(*[F.coalesce(F.col(f"{n}{k}").bitwiseAND(F.lit(_LOW)), F.lit(0)) for k in range(samples)]).alias(n) for n in names]
    )


def likeness(a: Column, b: Column) -> Column:
    """Share of equal samples."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return same / F.size(a)


def as_text(signature: Column) -> Column:
    """Eight hex digits a sample."""
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def edited_pairs(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every document with an edited text: its last quarter replaced by the start of the next document's.

    Returns (texts, order). texts: ident, h (which together name a document),
    doc_id, copies, text, edited. order: ident, h, next_ident, next_h.
    Whole texts move once; what is taken from the next document moves to it.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select(
        "doc_id", text.alias("text"),
        F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("ident"),
        F.xxhash64(text, F.col("doc_id").isNull()).alias("h"),
    )
    ids = keyed.groupBy("ident", "h").agg(F.max(F.length("text")).alias("n"))
    numbered = store(number_rows(ids, ["ident", "h"]), "documents_order")
    total = numbered.count()
    after = numbered.select(
        F.col("ident").alias("next_ident"), F.col("h").alias("next_h"),
        ((F.col("row_id") + (total - 1)) % max(total, 1)).alias("row_id"),
    )
    order = store(numbered.join(after, "row_id").select("ident", "h", "n", "next_ident", "next_h"), "documents_next")
    # read twice below, with the same columns both times, so that texts move once
    single = keyed.groupBy("ident", "h").agg(
        F.first(F.struct("doc_id", "text")).alias("doc"), F.count(F.lit(1)).alias("copies")
    )
    wanted = order.select(
        F.col("next_ident").alias("ident"), F.col("next_h").alias("h"),
        F.col("ident").alias("to_ident"), F.col("h").alias("to_h"), F.floor(F.col("n") / 4).cast("int").alias("q"),
    )
    lent = single.where("copies > 0").join(wanted, ["ident", "h"]).select(
        F.col("to_ident").alias("ident"), F.col("to_h").alias("h"), F.left("doc.text", F.col("q")).alias("lent")
    )
    length = F.length("doc.text")
    kept = F.left(F.col("doc.text"), length - F.floor(length / 4).cast("int"))
    texts = single.where("copies > 0").join(lent, ["ident", "h"]).select(
        "ident", "h", "doc.doc_id", "copies", "doc.text", F.concat(kept, "lent").alias("edited")
    )
    return texts, order.drop("n")


def compare_edited(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, signature, edited_signature, next_signature per row of ``docs``."""
    texts, order = edited_pairs(docs)
    both = texts.select(
        "ident", "h", "doc_id", "copies", F.length("text").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited"), 256).alias("edited_sha256"), "text", "edited",
    )
    key = ["ident", "h", "doc_id", "copies", "n_chars", "edited_sha256"]
    # kept and moved as 32-bit integers around zero, half the bytes of longs
    narrow = {c: F.transform(c, lambda x: (x - F.lit(1 << 31)).cast("int")) for c in ("signature", "edited_signature")}
    base = store(signatures(both, key, ("text", "edited"), samples).withColumns(narrow), "signatures")
    following = base.select(
        F.col("ident").alias("next_ident"), F.col("h").alias("next_h"), F.col("signature").alias("next_signature")
    )
    found = base.join(order, ["ident", "h"]).join(following, ["next_ident", "next_h"])
    wide = [
        F.transform(c, lambda x: x.cast("bigint") + F.lit(1 << 31)).alias(c)
        for c in ("signature", "edited_signature", "next_signature")
    ]
    return found.select(
        "doc_id", "n_chars", "edited_sha256", *wide,
        F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"),
    ).drop("copy")
