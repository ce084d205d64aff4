"""Phrases, packing and the manifest against brute force, on small tables with nulls, ties and odd texts."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textgraph.llm import merkle, packing, phrases

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, root string, key string, number int"


def table(spark, rows):
    """Rows ``(doc_id, text, lang, source)``, with further columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, lang, source, len(t or ""), "r", "k", 1) for i, t, lang, source in rows], DOCS)


# Phrases.


def brute_phrases(rows, longest, least, cover):
    counts, n = defaultdict(Counter), Counter()
    for _, text, lang, _ in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = [x for x in re.split("[\x20\x09]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, longest + 1):
                counts[lang].update(tuple(w[i : i + m]) for i in range(len(w) - m + 1))
    out = set()
    for lang, f in counts.items():
        for p, a in f.items():
            if len(p) < 2 or a < least:
                continue
            over = [b for q, b in f.items() if b >= least and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= cover * a for b in over):
                continue
            cuts = [(2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, l, r = min(cuts)
            out.add((lang, " ".join(p), a, l, r, n[lang], score))
    return out


@pytest.mark.parametrize("hot_floor", [phrases.HOT_FLOOR, 3])
def test_phrases_are_those_of_brute_force(spark, hot_floor):
    rng = np.random.default_rng(2)
    vocabulary = ["a", "b", "C", "dé", "e.", "f,", "g\th", "i\n", "\x0bj", "k'l"]
    rows = [(i, " ".join(rng.choice(vocabulary, int(rng.integers(0, 60)), p=[0.4] + [0.6 / 9] * 9)), ["en", "fr", None][i % 3], "s") for i in range(60)]
    rows += [(None, None, None, None), (1, "", "en", "s"), (1, " \t. ,", "xx", "s")] + [(7, "one two three four five", "en", "s")] * 9
    got = phrases.collocations(table(spark, rows), least=5, cover=60, hot_floor=hot_floor).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == brute_phrases(rows, 4, 5, 60)
    first = phrases.best(spark.createDataFrame(got), 3).collect()
    for lang in {r.lang for r in got}:
        want = sorted((-r.score, -r.a, r.phrase.encode()) for r in got if r.lang == lang)[:3]
        assert [(-r.score, -r.a, r.phrase.encode()) for r in sorted((r for r in first if r.lang == lang), key=lambda r: r["rank"])] == want


def test_a_long_text_and_none(spark):
    long = " ".join(f"w{i % 50}" for i in range(40_000))
    rows = [(1, long, "en", "s"), (2, "x" * 100_000, "en", "s")]
    assert {tuple(r) for r in phrases.collocations(table(spark, rows)).collect()} == brute_phrases(rows, 4, 30, 80)
    assert phrases.collocations(table(spark, [(1, "rare words", "en", "s")])).count() == 0
    assert phrases.best(phrases.collocations(table(spark, []))).count() == 0


def test_a_partial_stripe_is_ids_and_entries_alone(spark):
    docs = table(spark, [(i, "a b c d", "en", "s") for i in range(8)])
    sieve, none = np.full(phrases.SIEVE_BITS // 8, 255, np.uint8), np.zeros(0, np.uint64)
    rows = phrases.partial_stripes(docs, 2, sieve, (none, none)).toPandas()
    assert list(rows.columns) == ["prefix_id", "part", "stripe"] and {len(x) for x in rows["stripe"]} == {phrases.ENTRY.itemsize} == {12}


def test_stripes_add_up_beyond_32_bits():
    entry = np.array([(7, 2**32 - 1)], phrases.ENTRY)
    batch = pa.record_batch([pa.array([5]), pa.array([0]), phrases.packed(entry, np.array([0, 1]))], ["prefix_id", "part", "stripe"])
    held = None
    for _ in range(3):
        done, held = phrases.merged(batch, held, 30)
        assert done.num_rows == 0
    assert held[:2] == (5, 0) and held[2].tolist() == [7] and held[3].tolist() == [3 * (2**32 - 1)]


def test_large_counts_do_not_overflow(spark):
    rows = spark.createDataFrame([(1 << 61, 1 << 62, 1 << 62)], "a bigint, l bigint, r bigint")
    score = f"cast(a AS decimal(20, 0)) * {phrases.SCALE} div (cast(l AS decimal(20, 0)) + r)"
    assert rows.select(F.expr(score)).first()[0] == phrases.SCALE // 4


# Packing.


@pytest.fixture(scope="module")
def word_bpe():
    return pytest.importorskip("public_tokenizers").path("word_bpe_49k.json")


ODD = [
    None, "", " \n\t", "one", "Größe. ÀÉ İx ﬁ é. Á don't we'll it's.'s 'S", "<|startoftext|> a<|endoftext|>b <|ENDOFTEXT|>.",
    "漢字。 😀. \x0bx\x0cy\x85z q r \x1c.a", "x" * 5000, "a.b,c;d é: f̀." * 300, "word " * 6000, "Straßeͅ. ÷. a÷! 'll.", "١٢٣ 456. ⅷ ǅ.",
]


def check_pieces(pieces, texts, path, window):
    """The pieces cover each document's tokens once, and lie gapless in sequences of at most a window; gives their lengths."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    want = Counter()
    for i, text in texts:
        want[i, tuple([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1])] += 1
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for i, got in by_doc.items():
        tokens = [t for (j, t) in want.elements() if j == i]
        assert sum(p.length for p in got) == sum(map(len, tokens))
        if len(tokens) == 1:
            at = 0
            for p in sorted(got, key=lambda p: p.start):
                part = np.array(tokens[0][p.start : p.start + p.length], "<u4").tobytes()
                assert (p.start, p.doc_tokens, p.ids_crc32) == (at, len(tokens[0]), zlib.crc32(part))
                at += p.length
    assert by_doc.keys() == {i for i, _ in want}
    for got in by_sequence.values():
        got.sort(key=lambda p: p.offset)
        assert [p.offset for p in got] == np.concatenate([[0], np.cumsum([p.length for p in got])[:-1]]).tolist()
    lengths = [sum(p.length for p in got) for got in by_sequence.values()]
    assert max(lengths, default=0) <= window
    return lengths


@pytest.mark.parametrize("size", [200, packing.BLOCK_BYTES])
def test_pieces_hold_the_tokens_of_the_library(spark, word_bpe, size):
    texts = [*enumerate(ODD), *((100 + i, f"Some text number {i}. It has {'many ' * (i % 90)} words.") for i in range(300)), (None, "null id"), (7, "repeated"), (7, "repeated")]
    docs = table(spark, [(i, t, None, None) for i, t in texts]).repartition(2)
    pieces = packing.pack(docs, word_bpe, size=size).collect()
    lengths = check_pieces(pieces, texts, word_bpe, packing.WINDOW)
    padding = sum(0 if n & (n - 1) == 0 else packing.WINDOW - n for n in lengths)
    assert padding < 0.01 * sum(lengths)
    assert packing.pack(docs.limit(0), word_bpe).count() == 0


def test_the_cheapest_way_is_found():
    rng = np.random.default_rng(4)
    for window in (4, 7, 16):
        for _ in range(60):
            total = int(rng.integers(1, 60))
            ends = np.unique(np.append(rng.integers(1, total + 1, 4), total))
            places, fee = packing.cuts_of(total, ends, np.unique(rng.integers(1, total + 1, 5)), bool(rng.integers(2)), window)
            fees = dict(zip(places.tolist(), fee.tolist(), strict=True))

            def cost(way):
                sizes = np.diff(way)
                assert sizes.max() <= window
                return sum(fees[w] for w in way[1:]) + sum(0 if n & (n - 1) == 0 else window - n for n in sizes.tolist())

            best = {0: 0}
            for p in places.tolist()[1:]:
                best[p] = min(best[q] + cost([q, p]) for q in best if p - q <= window)
            assert cost(packing.cheapest(places, fee, window).tolist()) == best[total]


def test_a_cut_falls_behind_documents_and_sentences_first(word_bpe):
    runs = packing.Runs(word_bpe)
    import pyarrow as pa

    ids, sizes, sentences = packing.encoded(pa.array(["One two. Three four!\nfive", None, "six."]), runs)
    assert sizes.tolist() == [8, 1, 3] and sentences.tolist() == [3, 6, 11] and (ids[[7, 8, 11]] == 1).all()


# The manifest.


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows, fanout=16):
    """``{(doc_id, leaf): (subroot, root, proofs)}``, each proof the siblings on the way up."""

    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))

    def climb(nodes):
        """The top of a list of digests, and for each the siblings level by level."""
        paths, at, level = [[] for _ in nodes], [*range(len(nodes))], nodes
        while len(level) > 1:
            for i, a in enumerate(at):
                run = level[a // fanout * fanout :][:fanout]
                paths[i].append(("".join(run[: a % fanout]), "".join(run[a % fanout + 1 :])))
                at[i] = a // fanout
            level = [sha("".join(level[i : i + fanout])) for i in range(0, len(level), fanout)]
        return level[0], paths

    by_source = defaultdict(list)
    for row in rows:
        by_source[row[1]].append(((row[0] is not None, row[0] or 0), leaf(row)))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    tops = [climb([x for _, x in sorted(by_source[s])]) for s in names]
    root, above = climb([t for t, _ in tops])
    out = []
    for name, (subroot, paths), up in zip(names, tops, above, strict=True):
        for ((known, i), x), path in zip(sorted(by_source[name]), paths, strict=True):
            out.append((i if known else None, x, subroot, root, [s for pair in path + up for s in pair]))
    return out


def test_manifest_is_that_of_brute_force(spark):
    sizes = {"a": 1, "b": 16, "B": 17, "é": 300, None: 2, "": 5}
    rows = [(i * 7, f"Text {i}" if i % 5 else None, [None, "en"][i % 2], source) for source, n in sizes.items() for i in range(n)]
    rows += [(None, "no id", "en", "a"), (None, "no id either", "en", "a"), (3, "same", "en", "é"), (3, "same", "en", "é"), (5, "", None, "é"), (6, "long " * 50_000, "de", "a")]
    docs = table(spark, rows).repartition(3)
    got = merkle.manifest(docs).collect()
    want = brute_manifest([(i, source, lang, len(t or ""), t) for i, t, lang, source in rows])
    key = lambda r: (str(r[0]), *r[1:4], r[4])
    assert sorted(map(key, want)) == sorted(key((r.doc_id, r.leaf, r.subroot, r.root, [s for step in r.path for s in (step.before, step.after)])) for r in got)
    assert all(r.tampered_leaf == r.leaf for r in got)


def test_tampering_shows(spark):
    docs = table(spark, [(i, f"Text {i}" if i % 2 else "plain", "en", f"s{i % 3}") for i in range(60)])
    rows = merkle.manifest(docs, F.translate("text", merkle.UPPER, merkle.LOWER))
    ok = {r.doc_id: r.ok for r in rows.select("doc_id", (merkle.folded(F.col("tampered_leaf"), F.col("path")) == F.col("root")).alias("ok")).collect()}
    assert ok == {i: i % 2 == 0 for i in range(60)}
    assert merkle.manifest(docs.limit(0)).count() == 0
    alone = merkle.manifest(docs.limit(1)).first()
    assert alone.root == alone.subroot == alone.leaf and alone.path == []
