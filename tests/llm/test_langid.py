import math
import zlib
from collections import Counter, defaultdict

from textfeat.llm import langid, queries

SF = "/root/testdata/sf0.001"


def bins_of(text):
    """Bins of all n-grams of a text, one at a time."""
    letters = "".join(c if c.isalpha() else " " for c in text.lower()) + " " * (langid.ORDER - 1)
    for i in range(len(letters) - langid.ORDER + 1):
        key = 0
        for k, c in enumerate(letters[i : i + langid.ORDER]):
            key = (key * 0x01000193 ^ (ord(c) * 0x9E3779B1 + k + 1)) % 2**32
            if letters[i : i + k + 1].strip(" "):
                yield ((key * 0x85EBCA6B) % 2**32 >> (32 - langid.BITS)) % (2**langid.BITS - 1) + 1


def test_op6_is_plain_naive_bayes(spark):
    """Every row of the query against counters and logarithms in plain Python."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang").collect()
    held = {d.doc_id: zlib.crc32(str(d.doc_id).encode()) % 5 == 0 for d in docs}
    grams = {d.doc_id: list(bins_of(d.text)) for d in docs if langid.has_letter(d.text)}
    counts, number = defaultdict(Counter), Counter()
    for d in docs:
        if not held[d.doc_id] and d.lang is not None and d.doc_id in grams:
            counts[d.lang].update(grams[d.doc_id])
            number[d.lang] += 1
    mass = {lang: sum(c.values()) + 0.5 * 2**langid.BITS for lang, c in counts.items()}
    found = {r.doc_id: r for r in queries.op6_language(spark, SF).collect()}
    assert len(found) == len(docs) and len(counts) > 1
    for d in docs:
        r = found[d.doc_id]
        assert r.held_out == held[d.doc_id]
        if d.doc_id not in grams:
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        score = {
            lang: math.log(number[lang] / sum(number.values())) + sum(math.log((c[b] + 0.5) / mass[lang]) for b in grams[d.doc_id])
            for lang, c in counts.items()
        }
        best = max(sorted(score), key=score.get)
        assert r.lang_pred == best
        assert math.isclose(r.score, 1 / sum(math.exp(s - score[best]) for s in score.values()), abs_tol=0.01)
