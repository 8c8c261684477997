"""The corpus operators against brute force, on small tables with nulls, empties, ties, repeats and clashing names."""

import base64
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cinerank.llm import bpe, html_extract, lattice, line_dedup, mixing, quality, simhash, suffix_dedup, toxicity, warc

LETTERS = str.maketrans("0123456789", "abcdefghij")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, row string, score double, label int, k1 bigint, features int"


def docs_of(spark, texts, ids=None):
    ids = list(range(len(texts))) if ids is None else ids
    rows = [(i, t, "en", "s", len(t or ""), "x", 0.5, 1, 7, 3) for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, DOCS)


def words(rng, n, pool=400):
    return " ".join("w" + str(rng.randrange(pool)).translate(LETTERS) for _ in range(n))


@pytest.fixture(scope="module")
def odd_texts():
    rng = random.Random(1)
    long = words(rng, 3000, 100_000)
    return [None, "", "  \n\t\n ", "One line of text here", "one LINE of text here \x0b", "a\nb\na", long, long, words(rng, 80), "É" * 20 + "\n" + "é" * 20,
            "same words same words same words same words", "x" * 5000, long[:2000] + " changed " + long[2000:]]


def test_line_dedup_brute(spark, odd_texts):
    texts = [*odd_texts, "shared line number one\nown line of ten\n Shared Line Number ONE\t\nshort\nshort", "short\nshared line number one\nshared line number two\n",
             "shared line number two\n\nshared line number one"]
    ids = [*range(len(texts) - 1), 3]  # the last row repeats id 3
    for min_docs in (2, 3):
        holders = {}
        for i, t in zip(ids, texts):
            for line in (t or "").split("\n"):
                k = line.strip(" \t\n\x0b\x0c\r").translate(simhash.LOWER)
                if len(k) >= 10:
                    holders.setdefault(k, set()).add(i)
        expected = []
        for i, t in zip(ids, texts):
            lines = (t or "").split("\n")
            keys = [x.strip(" \t\n\x0b\x0c\r").translate(simhash.LOWER) for x in lines]
            stay = [x for x, k in zip(lines, keys) if len(k) < 10 or len(holders[k]) < min_docs or i == min(holders[k])]
            expected.append((i, "\n".join(stay), len(lines), len(lines) - len(stay), 0.5))
        got = line_dedup.dedup_lines(docs_of(spark, texts, ids), min_docs=min_docs).select("doc_id", "text", "_n_lines", "_n_dropped", "score").collect()
        assert sorted(map(tuple, got)) == sorted(expected)


def test_line_dedup_null_id_and_empty(spark):
    d = docs_of(spark, ["a line of some length", "a line of some length", "a line of some length"], [None, 1, 2])
    assert {(r.doc_id, r.text) for r in line_dedup.dedup_lines(d).collect()} == {(None, "a line of some length"), (1, "a line of some length"), (2, "")}
    assert line_dedup.line_dedup_digest(d.limit(0)).count() == 0


def fingerprint_plain(t):
    import xxhash
    w = WORD.findall((t or "").translate(simhash.LOWER))
    grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def components_plain(n, linked):
    label = list(range(n))
    for i in range(n):
        for j in range(i):
            if linked(i, j) and label[i] != label[j]:
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    return label


def test_simhash_brute(spark, odd_texts):
    rng = random.Random(2)
    base = [words(rng, 200) for _ in range(6)]
    near = []
    for b in base:
        for _ in range(12):
            w = b.split()
            w[rng.randrange(len(w))] = "edited"
            near.append(" ".join(w))
    texts = [*odd_texts, *base, *near]
    ids = [100 - i for i in range(len(texts))]
    fp = [fingerprint_plain(t) for t in texts]
    label = components_plain(len(texts), lambda i, j: (fp[i] ^ fp[j]).bit_count() <= 3)
    least = {}
    for i, c in zip(ids, label):
        least[c] = min(least.get(c, i), i)
    d = docs_of(spark, texts, ids)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_digest(d).collect()}
    assert got == {i: (f"{f:016x}", least[c]) for i, f, c in zip(ids, fp, label)}
    split = {r.doc_id: r.component_id for r in simhash.near_duplicates(d, block=3).collect()}  # every bucket in blocks
    assert split == {i: c for i, (_, c) in got.items()}
    four = {r.doc_id: r.component_id for r in simhash.near_duplicates(d, segments=4).collect()}
    assert four == split
    kept = simhash.keep_one(d)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def test_simhash_null_ids(spark):
    got = simhash.near_duplicates(docs_of(spark, ["a b c d", "a b c d", None], [None, 5, None])).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in got if r.fp) == [(-1, 5), (5, 5)]
    assert [r.component_id for r in got if not r.fp] == [None]
    assert simhash.simhash_digest(docs_of(spark, [])).count() == 0


def test_keep_one_loses_no_document(spark):
    rng = random.Random(21)
    alpha, beta, gamma = words(rng, 60), words(rng, 60), words(rng, 60)
    ids = [1, 1, 2, None, None, 7, 7, None]
    texts = [alpha, beta, beta, gamma, gamma, gamma, None, ""]
    d = docs_of(spark, texts, ids)
    for parts in (1, 5):
        kept = sorted((r.doc_id, r.text or "") for r in simhash.keep_one(d.repartition(parts)).collect())
        assert kept == sorted([(1, alpha), (1, beta), (7, gamma), (7, "")])
    only_null = simhash.keep_one(docs_of(spark, [gamma, gamma, alpha], [None, None, None])).collect()
    assert sorted(r.text for r in only_null) == sorted([alpha, gamma])
    assert simhash.keep_one(d.limit(0)).count() == 0


def test_probes_are_never_broadcast(spark):
    """33 probes a segment come of each fingerprint; by the size of the table of fingerprints they would look small enough."""
    from cinerank.session import materialize

    fps = materialize(spark.range(3000).select(F.xxhash64("id").alias("fp")), "fps")
    links = simhash.fingerprint_links(fps)
    links.collect()
    plan = links._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(re.match(r"[\s:+-]*", line)[0])
    for k, line in enumerate(plan):
        if "BroadcastExchange" in line:
            below = [x for x in plan[k + 1:]]
            end = next((j for j, x in enumerate(below) if depth(x) <= depth(line)), len(below))
            assert not any("MapInArrow" in x for x in below[:end])


def test_simhash_strips(spark):
    rng = np.random.default_rng(3)
    fp = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    fp[100:200] = fp[:100] ^ np.uint64(5)
    own = rng.random(300) < 0.7
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3
    near &= own[:, None] | own[None, :]
    label = components_plain(300, lambda i, j: near[i, j])
    least = {}
    for i, c in enumerate(label):
        least.setdefault(c, i)
    for strip in (1, 7, 256):
        assert simhash._roots(fp, own, 3, strip).tolist() == [least[c] for c in label]


def pages_of(spark, htmls, ids=None):
    ids = list(range(len(htmls))) if ids is None else ids
    return spark.createDataFrame([(i, f"http://h.example/{i} x", h, "t", 1) for i, h in zip(ids, htmls)], "page_id bigint, url string, html string, text string, sha int")


def test_warc_round_trip(spark, tmp_path):
    rng = random.Random(3)
    body = [f"<html><body>{words(rng, 60)}</body></html>" for _ in range(40)]
    htmls = [None, "", "é\r\n\r\nx", *body, body[0], body[1], body[0], "y" * 300_000]
    p = pages_of(spark, htmls)
    digests = [base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode() for h in htmls]
    first = {}
    for i, d in enumerate(digests):
        first.setdefault(d, i)
    expected = [(i, len((h or "").encode()), d, "response" if first[d] == i else "revisit", None if first[d] == i else first[d]) for i, (h, d) in enumerate(zip(htmls, digests))]
    got = [(r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.warc_digest(p).collect()]
    assert sorted(got, key=lambda r: r[0]) == expected
    folder = f"file://{tmp_path}/a"
    narrow = p.select("page_id", "url", "html")
    dictionary = warc.build_dictionary(narrow)
    assert dictionary
    index = warc.write_archives(warc.classify(narrow, min_revisit_bytes=1000), folder, dictionary, archive_bytes=300)
    assert index.count() > 3 and index.agg(F.sum("n_records")).first()[0] == len(htmls)
    back = {r.page_id: r for r in warc.read_archives(spark, folder).collect()}
    assert all(r.record_type == "response" for r in back.values())
    assert [bytes(back[i].payload).decode() for i in range(len(htmls))] == [h or "" for h in htmls]
    data = next((tmp_path / "a").glob("*.warc.zst")).read_bytes()
    assert data[:4] == (0x184D2A5D).to_bytes(4, "little") and data[8:8 + len(dictionary)] == dictionary


def test_warc_reads_what_the_index_lists(spark, tmp_path):
    p = pages_of(spark, [f"<p>page {i}</p>" * 5 for i in range(30)]).select("page_id", "url", "html")
    folder = f"file://{tmp_path}/w"
    index = warc.write_archives(warc.classify(p), folder, b"")
    name = index.first().path.rsplit("/", 1)[1]
    data = (tmp_path / "w" / name).read_bytes()
    (tmp_path / "w" / ("000000-99999-0000.warc.zst")).write_bytes(data)  # left by an attempt that was lost when it had written a file
    (tmp_path / "w" / ("000001-99998-0000.warc.zst")).write_bytes(data[:20])  # or half of one
    back = warc.read_archives(spark, folder)
    assert sorted(r.page_id for r in back.collect()) == list(range(30))


def test_warc_null_ids_and_empty(spark):
    got = warc.classify(pages_of(spark, ["a", "a", "b", "b"], [None, 4, None, None]).select("page_id", "url", "html")).collect()
    assert sorted((r.page_id or -1, r.record_type, r.refers_to or -1) for r in got) == [(-1, "response", -1), (-1, "response", -1), (-1, "revisit", 4), (4, "response", -1)]
    assert warc.warc_digest(pages_of(spark, [])).count() == 0


def test_quality_brute(spark, odd_texts):
    rng = random.Random(4)
    some = words(rng, 30)
    texts = [*odd_texts, some + " " + some, some + "\n" + some + "\n" + words(rng, 60), words(rng, 70) + " ### $$$ | a|b <x> %%%%%%%% &", "a b c a b c a b c", words(rng, 49), words(rng, 50)]

    def plain(t):
        t = t or ""
        w = WORD.findall(t)
        c = Counter(zip(w, w[1:], w[2:]))
        rep = {k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep), len(w) < 50 or 100 * len(rep) > 50 * len(w)

    got = {r.doc_id: r for r in quality.quality_digest(docs_of(spark, texts)).collect()}
    assert [tuple(got[i])[1:7] for i in range(len(texts))] == [plain(t) for t in texts]
    assert all(r.kept is not None and not (r.base_failed and r.kept) for r in got.values())
    assert got[len(texts) - 1].kept and not got[len(texts) - 4].kept
    assert quality.quality_digest(docs_of(spark, [])).count() == 0


def test_quality_order_does_not_change_the_verdict(spark, odd_texts):
    rng = random.Random(5)
    stats = quality.text_stats(docs_of(spark, [*odd_texts, *[words(rng, 60) + "\n- x ..." * k for k in range(9)]]))
    rules = quality.default_rules()
    a, b = (sorted(r.doc_id for r in quality.cascade(stats, x).where("rejected_by is null").collect()) for x in (rules, rules[::-1]))
    assert a == b
    assert {r.name for r in quality.order_rules(docs_of(spark, odd_texts), rules)} == {r.name for r in rules}


def ranks():
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_bpe_round_trip(spark, odd_texts):
    import tiktoken
    path, pattern = ranks()
    with open(path, "rb") as f:
        table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    rng = random.Random(6)
    texts = [*odd_texts, "<|endoftext|> it's  two   spaces \n\n end ", "日本語" * 50, " ".join(rng.choice(["don't", "x1", "  ", "\n", "é.", ". ", "A 1"]) for _ in range(4000))]
    d = docs_of(spark, texts)
    tokens = bpe.encode(d, path, pattern, piece_chars=50)
    assert {r.doc_id: list(r.ids) for r in tokens.collect()} == {i: enc.encode_ordinary(t or "") for i, t in enumerate(texts)}
    assert {r.doc_id: bytes(r.data) for r in bpe.decode(tokens, path, pattern).collect()} == {i: (t or "").encode() for i, t in enumerate(texts)}
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.bpe_digest(d, path, pattern).collect()}
    for i, t in enumerate(texts):
        ids = enc.encode_ordinary(t or "")
        assert got[i] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest())
    assert bpe.bpe_digest(docs_of(spark, []), path, pattern).count() == 0


def test_suffix_array():
    rng = random.Random(7)
    for _ in range(1500):
        s = [rng.randint(1, rng.choice([1, 2, 3, 9])) for _ in range(rng.randint(0, 40))] + [0]
        sa = suffix_dedup.suffix_array(s)
        assert list(sa) == sorted(range(len(s)), key=lambda i: s[i:])
        lcp = suffix_dedup.common_prefixes(s, sa)
        for r in range(1, len(s)):
            a, b = s[sa[r - 1]:], s[sa[r]:]
            assert lcp[r] == next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))


def repeats_plain(texts, length):
    data = [(t or "").encode() for t in texts]
    count = Counter(d[i:i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        cover = np.zeros(len(d), bool)
        for i in range(len(d) - length + 1):
            if count[d[i:i + length]] > 1:
                cover[i:i + length] = True
        kept = bytes(np.frombuffer(d, np.uint8)[~cover]) if d else b""
        spans = int((np.diff(np.concatenate([[0], cover.astype(int)])) == 1).sum()) if d else 0
        out.append((len(d), int(cover.sum()), spans, kept))
    return out


@pytest.mark.parametrize(("length", "width", "block"), [(400, 200, 4096), (60, 30, 4096), (60, 30, 2), (60, 2, 4096), (40, 40, 3)])
def test_suffix_dedup_brute(spark, odd_texts, length, width, block):
    rng = random.Random(length + width)
    shared = [words(rng, 100) for _ in range(4)]
    texts = [*odd_texts, "ab" * 400, "z" * 900, "z" * 401]
    for k in range(25):
        s = rng.choice(shared)
        a = rng.randrange(len(s) - 200)
        texts.append(words(rng, rng.randrange(40)) + s[a:a + rng.randrange(30, 600)] + words(rng, rng.randrange(40)) + ("é" * 300 if k % 7 == 0 else "") + s[:rng.randrange(500)])
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs_of(spark, texts), length, width, block).collect()}
    for i, e in enumerate(repeats_plain(texts, length)):
        r = got[i]
        assert (len(r.data), sum(x.to - x["from"] for x in r.spans), len(r.spans), bytes(r.kept)) == e, i


def test_suffix_dedup_many_copies(spark):
    rng = random.Random(12)
    text = words(rng, 700)
    texts = [text] * 1000 + [text[:500], "y " + text[300:1200], text[:399], words(rng, 300)] + [words(rng, 60) + text[700:1300]] * 3
    got = {r.doc_id: r for r in suffix_dedup.remove_repeats(docs_of(spark, texts)).collect()}
    plain = repeats_plain([text, text, *texts[1000:]], 400)
    for i, e in zip([0, 999, *range(1000, len(texts))], plain, strict=True):
        r = got[i]
        assert (len(r.data), sum(x.to - x["from"] for x in r.spans), len(r.spans), bytes(r.kept)) == e, i
    t = docs_of(spark, texts).select(F.unhex(F.md5("text")).alias("t"), F.col("text").cast("binary").alias("data"))
    rows = suffix_dedup.repeated_ranges(t.where(F.octet_length("data") >= 400)).collect()
    of_copy = [r for r in rows if bytes(r.t).hex() == hashlib.md5(text.encode()).hexdigest()]
    assert len(of_copy) < 200 and max(len(r.ranges) for r in rows) <= 200  # as for one text, not a thousand


def test_suffix_digest_empty(spark):
    assert suffix_dedup.suffix_digest(docs_of(spark, [])).count() == 0
    assert [(r.n_bytes, r.n_spans) for r in suffix_dedup.suffix_digest(docs_of(spark, [None], [None])).collect()] == [(0, 0)]


def test_anchor_chunks_of_a_very_long_text(spark, monkeypatch):
    rng = random.Random(8)
    part = "".join(rng.choice("abcdefgh ") for _ in range(3000))
    big = "".join(rng.choice("abcdefgh ") for _ in range(1_200_000)) + part
    got = {r.doc_id: r.n_removed for r in suffix_dedup.suffix_digest(docs_of(spark, [big, "x" + part])).collect()}
    assert got == {0: 3000, 1: 3000}


def labelled_docs(spark):
    rng = random.Random(9)
    rows, labels = [], []
    langs = {"en": "the and of with house water", "de": "der und nicht haus wasser straße", "fr": "le et dans maison eau été"}
    for i in range(400):
        lang = rng.choice(["en", "en", "en", "de", "fr"])
        w = [rng.choice(langs[lang].split()) + rng.choice(["", "s", "en"]) for _ in range(rng.randrange(1, 80))]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w) + 1), rng.choice(["idiot", "blorkface", "moron"]))
        rows.append((i, " ".join(w), lang, "s", 1, "x", 0.5, 1, 7, 3))
        labels.append((i, 1, toxic))
    rows += [(500, None, None, None, None, None, None, None, None, None), (501, "", "en", "s", 0, "x", 0.5, 1, 7, 3), (None, "the house", "en", "s", 9, "x", 0.5, 1, 7, 3)]
    labels += [(500, 1, 0), (None, 1, 1), (999, 0, 1), (7, 1, None)]
    return spark.createDataFrame(rows, DOCS), spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity(spark):
    docs, labels = labelled_docs(spark)
    got = toxicity.toxicity_digest(docs, labels).toPandas()
    assert len(got) == 403 and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    both = got[got.held_out].merge(labels.where("doc_id < 400 and toxic is not null").toPandas(), on="doc_id")
    assert (both.predicted == both.toxic).mean() > 0.9
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns and set(kept.where("doc_id is not null").toPandas().doc_id) == set(got[(got.predicted == 0) & got.doc_id.notna()].doc_id)
    few = toxicity.toxicity_digest(docs, labels.limit(0)).toPandas()
    assert few.score.between(0, 1).all() and few.predicted.sum() > 0
    assert toxicity.toxicity_digest(docs.limit(0), labels).count() == 0


def test_toxicity_features():
    w = dict.fromkeys(toxicity.SEED_LEXICON, 3.0)
    f = toxicity.features("You are an IDIOT, you id1ot!", w)
    assert len(f) == toxicity.FEATURES and f[0] > 0 and f[6] == 1.0 and f[12] > 0
    assert toxicity.features("", w)[:3] == [0.0, 0.0, 0.0]


def test_mixing(spark):
    docs, labels = labelled_docs(spark)
    target = {"en": 0.4, "de": 0.3, "fr": 0.3}
    rates, names = mixing.mix_rates(docs, labels, target)
    t = rates.toPandas()
    assert names == ["de", "en", "fr"] and (t.rate >= 0).all()
    p, n, r = t[["p0", "p1", "p2"]].to_numpy(), (t.n_words * t.copies).to_numpy(), t.rate.to_numpy()
    assert np.allclose(p.sum(axis=1), 1) and t.copies.sum() == docs.count()
    # plain projected gradient on the same posteriors, run to the end
    have, want = (n[:, None] * p).sum(axis=0), n.sum() * np.array([0.3, 0.4, 0.3])
    gram = (p * n[:, None]).T @ p / np.sqrt(np.outer(have, have))
    q = np.ones(len(n))
    for _ in range(3000):
        q = np.maximum(0, q - p @ (((q * n) @ p - want) / have) / np.linalg.eigvalsh(gram)[-1])
    assert np.abs((q * n) @ p - (r * n) @ p).max() < 0.005 * n.sum()
    assert np.abs((r * n) @ p / n.sum() - [0.3, 0.4, 0.3]).max() < 0.01
    got = mixing.mixing_digest(docs, labels, target).toPandas()
    assert len(got) == docs.count() and (abs(got.n_copies - got.rate) < 1).all()
    mixed = mixing.mix(docs, labels, target, keep_all=True)
    assert mixed.columns == docs.columns and mixed.select("doc_id").distinct().count() == docs.select("doc_id").distinct().count()
    assert mixing.mix(docs, labels.limit(0), target).count() == docs.count()
    assert mixing.mixing_digest(docs.limit(0), labels, target).count() == 0


def test_html(spark):
    chrome = "<nav><ul><li><a href='/x'>Menu</a></ul></nav><div class='cookie-notice'>We use cookies</div>"
    tail = "<section class='who'><p>About this site</p><p>Imprint</section><div class='comments'><p>first!</div><footer>&copy; f</footer></body></html>"
    page = lambda body: f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{chrome}{body}{tail}"
    htmls = [page(f"<div><h1>Title {i}</h1><p>One  &amp;\n two {i}<p>three<br>four <b>bold {i}</div>") for i in range(8)]
    htmls += [page("<article><header><h1>Head</h1></header><p>About this site</p><form>f</form><script>var t='</p>';</script>End</article>"), None, "", "plain &lt; text", "<p>cut <b>off", "<div " + "<div>" * 3000 + "deep"]
    got = {r.page_id: r for r in html_extract.html_digest(pages_of(spark, htmls)).collect()}
    joined = html_extract.extract_pages(pages_of(spark, htmls), broadcast_trees=0)  # templates met in a join
    assert joined.columns == ["page_id", "url", "sha", "text"] and {r.page_id: r.text for r in joined.collect()} == {i: r.text for i, r in got.items()}
    for i in range(8):  # the section recurs on all pages of the host: a template
        assert got[i].text == f"Title {i}\n\nOne & two {i}\n\nthree four bold {i}"
    assert [got[i].text for i in range(8, 13)] == ["Head\n\nAbout this site\n\nEnd", "", "", "plain < text", "cut off"]
    assert got[13].text.endswith("deep") and got[8].n_chars == len(got[8].text)
    # in a marked article, recurring boxes go and recurring running text stays
    box = "<div><ul><li>Follow us</li></ul></div>"
    art = [f"<nav>n{i}</nav><article><h1>Same</h1><div><p>Shared passage</p></div>{box}<p>own {i}</p><div>also {i}</div></article><div>x{i}</div>" for i in range(6)]
    texts = [r.text for r in html_extract.html_digest(pages_of(spark, art)).orderBy("page_id").collect()]
    assert texts == [f"Same\n\nShared passage\n\nown {i}\n\nalso {i}" for i in range(6)]
    assert html_extract.html_digest(pages_of(spark, [])).count() == 0


@pytest.mark.parametrize("tag", ["article", "main"])
def test_html_recurring_boxes_of_headings_and_paragraphs(spark, tag):
    box = "<div class='x'><h3>Popular</h3><ul><li>One</li><li>Two</li></ul><p>Read more of these every week</p></div>"
    other = "<div><span>Letter</span><p>Subscribe to our letter</p></div>"
    own = [f"<{tag}><h1>Title {i}</h1><div><p>Shared passage.</p><p>Own text {i}.</p>{other}</div>{box}</{tag}>" for i in range(8)]
    copied = [f"<p>{i}</p><{tag}><h1>Title {i}</h1><div class='body'><p>Copied text of some length.</p>{other}</div></{tag}>" for i in range(8)]
    divs = [f"<{tag}><div>Text without paragraphs, but much longer than the box beside it, as it should be on page {i}, "
            f"and on all others of its kind, too.</div>{box}</{tag}>" for i in range(8)]
    for htmls, said in ((own, "Title {0}\n\nShared passage.\n\nOwn text {0}."), (copied, "Title {0}\n\nCopied text of some length."),
                        (divs, "Text without paragraphs, but much longer than the box beside it, as it should be on page {0}, and on all others of its kind, too.")):
        texts = [r.text for r in html_extract.html_digest(pages_of(spark, htmls)).orderBy("page_id").collect()]
        assert texts == [said.format(i) for i in range(8)]


def test_html_box_on_a_small_share_of_a_large_host(spark):
    """Six of 60 pages hold the box: a template only for a caller who asks for a smaller share of the host."""
    box = "<div><h3>Popular</h3><ul><li>One</li></ul><p>Subscribe to our letter</p></div>"
    htmls = pages_of(spark, [f"<article><p>Own text {i}.</p>{box if i < 6 else ''}</article>" for i in range(60)])
    for share, n in ((0.2, 6), (0.05, 0)):
        got = html_extract.extract_pages(htmls, min_share=share)
        assert got.where("text like '%Subscribe%'").count() == n and got.where("text like 'Own text%'").count() == 60


def test_mixing_keeps_a_rare_domain(spark):
    rng = random.Random(31)
    rows = [(i, words(rng, 12), "en" if i else "xx", "s", 1) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    model = mixing.fit_domains(docs, docs.select("doc_id"), max_rows=20)
    assert model.domains == ["en", "xx"] and abs(sum(math.exp(x) for x in model.prior) - 1) < 1e-9 and math.exp(model.prior[1]) < 0.02
    post = mixing.posteriors(docs, model)
    with pytest.raises(RuntimeError):
        mixing.fit_rates(post, [0.01, 0.99], total_tokens=50_000, max_steps=1)
    assert mixing.fit_rates(post, [0.5, 0.5], max_steps=400).where("rate < 0").count() == 0


def test_menus_with_words_of_their_own_are_templates(spark):
    """The entries of each page's menu are its own; their shape is the site's. A list of links in the article stays."""
    rng = random.Random(23)
    rows = []
    for i in range(40):
        entry = [f'<li><a href="/{k}-{i}">{words(rng, 2)}</a></li>' for k in range(rng.randrange(3, 9))]
        links = "".join(f'<li><a href="/r{i}{k}">source {i} {k}</a></li>' for k in range(4))
        body = f"<p>{words(rng, 40)}</p>"
        rows.append((i, "http://own.example/x", f'<div class="x{i}"><ul>{"".join(entry)}</ul></div>{body}'))
        rows.append((100 + i, "http://main.example/x", f'<div class="m"><ul>{"".join(entry)}</ul></div><article>{body}<ul>{links}</ul></article>'))
    rows.append((200, "http://small.example/x", rows[0][2]))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in html_extract.extract_pages(pages, by_name=False).collect()}
    for i, _, source in rows:
        text = re.search("<p>(.*)</p>", source)[1]
        if i < 100:
            assert got[i] == text
        elif i < 200:
            assert got[i].startswith(text) and f"source {i - 100} 3" in got[i]
    assert got[200] != got[0]  # a site of one page has no templates


def test_html_odd_markup_is_linear():
    import time
    for odd in ('<a "', "<a '", "<a ", "<!", "<!-- x ", '<a ">" ', "<", '<p x="', "<script ", "</a '"):
        for tail in ("", ">", "'", '"', "' >"):
            source = "<p>begin</p>" + odd * (1_000_000 // len(odd)) + tail
            t = time.process_time()
            root = html_extract.parse(source)
            assert root.kids and time.process_time() - t < 3, (odd, tail)
    assert html_extract.extract('<p>1 < 2 and <b title="a > b">bold</b> <i x=">it</p><p>next</p>', set()).startswith("1 < 2 and bold")


def test_html_hidden_and_teasers():
    page = '<div hidden>secret</div><div HIDDEN="">secret</div><p data-hidden="x">seen</p>'
    assert html_extract.extract(page, set()) == "seen"
    teaser = '<article><h2><a href="/b">Another story</a></h2><p>short</p></article>'
    body = "<article><h1>Title</h1><p>" + "long text " * 40 + "</p></article>"
    assert "Another" not in html_extract.extract(teaser + body + teaser, set())
    assert html_extract.extract(teaser + teaser, set()).count("Another story") == 2  # an overview page


def test_templates_by_themselves_equal_a_plain_count(spark):
    """Subtrees counted per host in plain Python give the same removals as the operator, with the name lists switched off."""
    rng = random.Random(17)
    rows = []
    for i in range(60):
        host = f"http://h{i % 3}.example/p{i}"
        menu = f'<div class="x{i % 3}"><ul><li>Home {i % 3}</li><li>About</li></ul></div>' if i % 4 else ""
        rows.append((i, host, f"<body>{menu}<div><p>{words(rng, 20)}</p></div><div><span>foot {i % 3}</span></div></body>"))
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    trees, total = {}, Counter()
    for i, url, source in rows:
        host = url.split("/")[2]
        total[host] += 1
        for h in html_extract.hashes_of(source, 0):
            trees.setdefault((host, h), set()).add(i)
    common = {k for k, v in trees.items() if len(v) >= 5 and len(v) >= 0.2 * total[k[0]]}
    assert common
    got = {r.page_id: r.text for r in html_extract.extract_pages(pages, by_name=False).collect()}
    changed = 0
    for i, url, source in rows:
        own = {h for host, h in common if host == url.split("/")[2]}
        plain = html_extract.extract(source, own, 0, by_name=False)
        assert got[i] == plain and "About" not in plain and "foot" not in plain
        changed += plain != html_extract.extract(source, set(), 0, by_name=False)
    assert changed == 60


def test_nearest_e8():
    rng = np.random.default_rng(10)
    near = lattice.minimal_vectors()
    assert near.shape == (240, 8) and np.allclose((near ** 2).sum(axis=1), 2)
    x = rng.normal(size=(300, 8)) * 2
    q = lattice.nearest_e8(x)
    d = ((x - q) ** 2).sum(axis=1)
    assert d.max() <= 1 + 1e-9  # the covering radius is 1
    assert (((x[:, None] - q[:, None] - near[None]) ** 2).sum(axis=2) >= d[:, None] - 1e-9).all()


@pytest.mark.parametrize("dim", [16, 32, 64, 768])
@pytest.mark.parametrize("threshold", [0.9, 0.95])
def test_lattice_recall_near_the_threshold(dim, threshold):
    rng = np.random.default_rng(dim)
    u = lattice.units(rng.normal(size=(2000, dim)))
    z = rng.normal(size=(2000, dim))
    z = lattice.units(z - (z * u).sum(axis=1, keepdims=True) * u)
    c = rng.uniform(threshold, threshold + 0.01, size=(2000, 1))
    a, b = (lattice.cells(x, 8, 2, 2, lattice.scale_of(dim, threshold, 2), 17) for x in (u, c * u + np.sqrt(1 - c * c) * z))
    met = ((a[:, :, :1] == b).any(axis=2) | (b[:, :, :1] == a).any(axis=2)).any(axis=1)
    assert met.mean() >= 0.99


def vectors(spark):
    rng = np.random.default_rng(11)
    base = rng.normal(size=(150, 64))
    rows = [v for v in base]
    for v in base[:60]:
        u = v / np.linalg.norm(v)
        for c in (0.952, 0.97, 0.99):
            z = rng.normal(size=64)
            z -= (z @ u) * u
            rows.append(3 * (c * u + np.sqrt(1 - c * c) * z / np.linalg.norm(z)))
    centre = rng.normal(size=64)
    rows += [centre + 0.05 * rng.normal(size=64) for _ in range(80)] + [base[0], base[0]]
    data = [(i, [float(x) for x in np.float32(v)], 1, "x") for i, v in enumerate(rows)]
    n = len(data)
    data += [(n, None, 1, "x"), (n + 1, [], 1, "x"), (n + 2, [0.0] * 64, 1, "x"), (n + 3, [float("nan")] + [1.0] * 63, 1, "x"), (n + 4, [None] + [1.0] * 63, 1, "x"),
             (n + 5, [float("inf")] + [1.0] * 63, 1, "x"), (n + 6, [1.0, 2.0], 1, "x"), (n + 7, [2.0, 4.0], 1, "x"), (None, [1.0, 2.0], 1, "x")]
    return data, spark.createDataFrame(data, "vec_id bigint, embedding array<float>, label int, node string")


@pytest.mark.parametrize("block", [512, 16])
def test_lattice_against_brute_force(spark, block):
    data, df = vectors(spark)
    got = {r.vec_id: r for r in lattice.near_vectors(df, block=block).collect()}
    assert len(got) == len(data) and got[None].n_links == 0 and got[None].kept
    ok = [(i, np.array(v, float)) for i, v, _, _ in data if i is not None and v and len(v) == 64 and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    u = np.array([v / np.linalg.norm(v) for _, v in ok])
    link = u @ u.T >= 0.95
    np.fill_diagonal(link, False)
    exact = link.sum(axis=1)
    found = np.array([got[i].n_links for i, _ in ok])
    assert (found <= exact).all() and found.sum() >= 0.97 * exact.sum()
    if (found == exact).all():
        label = components_plain(len(ok), lambda i, j: link[i, j])
        least = {}
        for (i, _), c in zip(ok, label):
            least[c] = min(least.get(c, i), i)
        assert all(got[i].component_id == least[c] for (i, _), c in zip(ok, label))
    n = len(data) - 9
    assert all(got[n + k].n_links == 0 and got[n + k].kept for k in range(6))
    assert got[n + 7].n_links == 1 and got[n + 7].component_id == n + 6 and not got[n + 7].kept
    assert lattice.near_vectors(df.limit(0)).count() == 0


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    docs, labels = labelled_docs(spark)
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    extra = spark.createDataFrame([(600, "the house of water " * 30, "en", "s", 1), (601, "the house of water " * 30, "en", "s", 1)], docs.schema)
    docs.unionByName(extra).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    d = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, d, str(tmp_path))
        assert out.columns == docs.columns, name
        d = spark.createDataFrame(out.collect(), docs.schema)
        if name == "simhash_near_dedup":
            assert d.where("doc_id in (600, 601)").count() == 1
            one = simhash.near_duplicates(d).where("doc_id is not null")
            assert one.count() == one.select("component_id").distinct().count()
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() == d.count()
