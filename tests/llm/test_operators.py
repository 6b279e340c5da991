"""Each operator against a brute-force version, an exact round trip or held-out accuracy, on small fixtures."""

import binascii
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from venuelake.llm import bpe, decontaminate, html_trees, langid, line_dedup, maxent_lm, near_dedup, perplexity_rules, pii_crf, quality_crf
from venuelake.llm.components import components
from venuelake.llm.words import Words

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BPE = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, rows, schema="doc_id long, text string"):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


# --- shared parts

def test_words_and_grams():
    w = Words([b"", b"The the", b"a \x0b THE\n", b" \x85\xc2\x85 ", b"x"])
    assert np.diff(w.first).tolist() == [0, 2, 2, 1, 1]
    assert w.hash[0] == w.hash[1] == w.hash[3] != w.hash[2]
    grams, at = w.grams(2)
    assert at.tolist() == [0, 2] and grams[0] != grams[1]


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    got = {r.node: r.root for r in components(frame(spark, edges, "a long, b long"), "t").collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 160)}}


# --- 1

def test_quality_forward_backward_is_exact():
    rng = np.random.default_rng(1)
    emission, transition, first = rng.normal(size=9), rng.normal(size=(2, 2)), np.array([0, 4, 5, 9])
    p, expected = quality_crf.marginals(emission, first, transition)
    for k, (a, b) in enumerate(zip(first[:-1], first[1:])):
        total, good, pairs = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for code in range(1 << (b - a)):
            y = [code >> i & 1 for i in range(b - a)]
            weight = math.exp(sum(emission[a + i] * v for i, v in enumerate(y)) + sum(transition[u, v] for u, v in zip(y, y[1:])))
            total += weight
            good += weight * np.array(y)
            for u, v in zip(y, y[1:]):
                pairs[u, v] += weight
        assert np.allclose(p[a:b], good / total) and np.allclose(expected[k], pairs / total)


def test_quality_held_out(spark):
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = quality_crf.classify(d, labels).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.quality for r in got) >= 0.95 * len(got) > 50
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)


# --- 2

def brute_components(texts, n, percent):
    sets = {}
    for d, t in texts.items():
        w = WORD.findall((t or "").translate(LOW))
        sets[d] = frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(d for d in sets if sets[d])
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if 100 * shared >= percent * (len(sets[a]) + len(sets[b]) - shared):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return {d: (len(sets[d]), find(d), find(d) == d) for d in sets}


def near(df, **kw):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_dedup.near_groups(df, **kw).collect()}


def test_near_groups_match_brute_force(spark):
    """Chains, small sets and a group of copies that are not all alike one another."""
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(400)]
    texts, base = {}, [rng.choice(vocabulary) for _ in range(150)]
    for i in range(260):
        kind = i % 4
        if kind < 2:  # one large group of copies with few to many changes
            w = list(base)
            for _ in range(rng.randint(0, 9)):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
        elif kind == 2:  # a drifting chain
            drift = base[:60] if i == 2 else drift[1:] + [rng.choice(vocabulary)]
            w = drift
        else:  # small sets
            w = [rng.choice("abc") for _ in range(rng.randint(0, 9))]
        texts[i] = " ".join(w)
    texts[900] = None
    want = brute_components(texts, 3, 85)
    got = near(frame(spark, [*texts.items()]), words=3, percent=85)
    assert got == want
    assert len({c for _, c, kept in want.values() if not kept}) > 3


def test_blocks_count_shared_values():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 9000, rng.integers(1, 3000))).astype(np.uint64) for _ in range(9)]
    got = near_dedup.shared_counts(sets[:4], sets[4:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[4:]] for a in sets[:4]]


def test_every_pair_at_the_threshold_has_a_sure_run():
    for percent in (80, 85):
        _, small = near_dedup.run_lengths(percent)
        for union in range(1, 21):
            missing = union * (100 - percent) // 100
            for size in range(union - missing, union + 1):
                sure = max(1, math.ceil((union - missing) / (missing + 1)))
                assert any(x <= sure for x in small[size])


# --- 3

def test_base_scores_and_counts(spark, docs, texts):
    counts = Counter()
    for d, t in texts.items():
        if binascii.crc32(str(d).encode()) % 7 != 2:
            counts.update([*WORD.findall(t.translate(LOW)), "\n"])
    total, types = sum(counts.values()), len(counts)
    held = base = model = 0
    for r in maxent_lm.score_texts(docs).collect():
        w = [*WORD.findall(texts[r.doc_id].translate(LOW)), "\n"]
        want = sum(math.log10((counts[x] + 1) / (total + types + 1)) for x in w)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (binascii.crc32(str(r.doc_id).encode()) % 7 == 2, len(w), sum(counts[x] > 0 for x in w), total)
        assert abs(r.base_score - want) < 1e-6 * abs(want) and r.score < 0
        if r.held_out:
            held, base, model = held + 1, base + r.base_score, model + r.score
    assert held and model > base


def test_rare_tokens_are_joined(spark, docs, monkeypatch):
    whole = {r.doc_id: r for r in maxent_lm.score_texts(docs).collect()}
    monkeypatch.setattr(maxent_lm, "KNOWN", 400)
    for r in maxent_lm.score_texts(docs).collect():
        assert r.n_known == whole[r.doc_id].n_known and abs(r.score - whole[r.doc_id].score) < 1e-6 and abs(r.base_score - whole[r.doc_id].base_score) < 1e-6


def test_probabilities_sum_to_one():
    """Over the known tokens and one unseen type of each tail class, after any history."""
    rng = np.random.default_rng(3)
    hashes = rng.integers(1, 1 << 62, 500).astype(np.int64)
    counts = np.sort(rng.integers(1, 50, 500))[::-1]
    kinds = {k: (int(counts[320:][np.arange(180) % 6 == k].sum()), 30) for k in range(6)}
    m = maxent_lm.Model(hashes, counts, kinds, int(counts.sum()), 500)
    m.rows += rng.normal(size=m.rows.shape).astype(np.float32)
    m.inner += rng.normal(size=m.inner.shape).astype(np.float32)
    x = maxent_lm.softmax((m.bias + m.rows[3] + m.rows[5] + m.rows[7])[None].astype(np.float64))[0]
    inside = maxent_lm.softmax((m.slot_bias + m.inner[1] + m.inner[2]).astype(np.float64)).sum(1)
    tail = [(counts[320:][np.arange(180) % 6 == k] + 1).sum() + 1 for k in range(6)]
    assert abs((x[:10] * inside).sum() + (x[10:] * np.array(tail) / m.tail_size).sum() - 1) < 1e-6


# --- 4

def test_passages_within_the_bound_are_found():
    rng = random.Random(3)
    vocabulary = [f"word{i}" for i in range(300)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randint(5, 60))] for _ in range(80)]
    block = decontaminate.Items([*range(80)], [" ".join(w).encode() for w in items], 0.8)
    found = planted = 0
    for i, w in enumerate(items):
        w = list(w)
        for _ in range(int(len(w) * 0.2 + 1e-9)):
            k, kind = rng.randrange(len(w)), rng.random()
            if kind < 0.34:
                w[k] = rng.choice(vocabulary)
            elif kind < 0.67:
                w.insert(k, rng.choice(vocabulary))
            elif len(w) > 1:
                del w[k]
        around = [rng.choice(vocabulary) for _ in range(40)]
        text = " ".join([*around[:20], *w, *around[20:]]).upper() + "."
        if decontaminate.best_passage(block.words[i], Words([decontaminate.normalise(text.encode())], fold=False).hash)[0] <= block.allowed[i]:
            planted += 1
            found += any(x[1] == i for x in block.matches([text.encode()]))
    assert planted > 70 and found >= 0.98 * planted
    assert not block.matches([" ".join(rng.choice(vocabulary) for _ in range(5000)).encode()])


def test_passage_distance_is_exact():
    rng = np.random.default_rng(5)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 7)), rng.integers(0, 4, rng.integers(0, 9))

        def edit(x, y):
            row = [*range(len(y) + 1)]
            for i, u in enumerate(x, 1):
                row = [i] + [0] * len(y) if False else row
                new = [i]
                for j, v in enumerate(y, 1):
                    new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (u != v)))
                row = new
            return row[-1]

        want = min(edit(a.tolist(), b[i:j].tolist()) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        assert decontaminate.best_passage(a, b)[0] == want


def test_benchmark_in_blocks(spark, docs, monkeypatch):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    whole = sorted(map(tuple, decontaminate.contaminated(docs, bench).collect()))
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 12)
    assert sorted(map(tuple, decontaminate.contaminated(docs, bench).collect())) == whole and whole
    assert decontaminate.clean(docs, bench).count() == docs.count() - len({d for d, *_ in whole})


# --- 5

def test_bpe_equals_the_library(spark, texts):
    from tokenizers import Tokenizer

    rng = random.Random(1)
    parts = ["a", "b", "e", "the", "ing", "é", "Ü", "İ", "Σ", "ς", "́", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "'s", "'LL", " ", "\n", " ", "\x1c", "\x85", "1", "²", "½", "漢", "😀", "‍", "-", "!!", "ẞ", "\x00", "ﬁ", "가", "aaaa", "x" * 90]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))) for i in range(3000)]
    rows += [(5000 + d, t) for d, t in texts.items()] + [(9000, None), (9001, ""), (9002, "long" * 40_000 + " " + "ab" * 5000)]
    library = Tokenizer.from_file(BPE)
    for r in bpe.encode_documents(frame(spark, rows), BPE, keep_ids=True).collect():
        ids = library.encode(dict(rows)[r.doc_id] or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        assert r.ids == ids and r.decoded == shown and r.n_tokens == len(ids), r.doc_id
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and r.decoded_sha256 == hashlib.sha256(shown.encode()).hexdigest()


def test_bpe_store_can_be_emptied():
    m = bpe.BpeModel(BPE)
    before = [*m.encode([b"some words and more", b"words"])]
    m.forget([])
    assert [*m.encode([b"some words and more", b"words"])] == before


# --- 6

def brute_spans(t):
    found = []
    for kind, pattern in enumerate((r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, t):
            digits = re.sub(r"[^0-9]", "", m[0])
            if kind == 1 and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == 2 and not (16 <= len(digits) <= 19 and sum((lambda x: x - 9 if x > 9 else x)(int(c) * (1 + i % 2)) for i, c in enumerate(reversed(digits))) % 10 == 0):
                continue
            if kind == 3 and not 8 <= len(digits) <= 15:
                continue
            found.append((kind, *m.span()))
    return found


def test_pii_base_spans():
    rng = random.Random(1)
    parts = [*"0123456789", *"0123456789", *"@@..--++()  ab_%", "\n", "é", "4111111111111111", "1.2.3.4", "a@b.c"]
    for _ in range(20_000):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        assert pii_crf.base_spans(t) == brute_spans(t), t
    for t in ("1" * 50_000, "a" * 50_000, "1." * 30_000, "+1" * 20_000, "a@" * 20_000):
        pii_crf.base_spans(t)


def test_pii_repeats_are_found(spark):
    text = "Write to bob.smith@corp.com today. Later: bob.smith (at) corp (dot) com."
    df = frame(spark, [(1, text), (2, "order 1234567890 and 1234567890"), (3, None), (4, "é card 4111 1111 1111 1111")])
    got = {r.doc_id: r for r in pii_crf.find(df).collect()}
    a = text.index("bob.smith (at)")
    assert got[1].spans == f"email:9:27,email:{a}:{len(text) - 1}" and got[1].n_email == 1 and got[1].n_added == 1
    assert got[2].spans == "" and got[3].spans == "" and got[3].base_sha256 == hashlib.sha256(b"").hexdigest()
    assert got[4].spans == "card:7:26" and got[4].base_sha256 == hashlib.sha256(b"card:7:26").hexdigest()


def test_loopy_messages_are_exact_on_trees():
    rng = np.random.default_rng(2)
    node, edges, potential = rng.normal(size=(4, 3)), np.array([[0, 1], [1, 2], [1, 3]]), rng.normal(size=(3, 3, 3))
    total, want = 0.0, np.zeros((4, 3))
    for code in range(81):
        y = [code // 3**i % 3 for i in range(4)]
        w = math.exp(sum(node[i, v] for i, v in enumerate(y)) + sum(potential[k, y[a], y[b]] for k, (a, b) in enumerate(edges)))
        total += w
        for i, v in enumerate(y):
            want[i, v] += w
    assert np.allclose(pii_crf.marginals(node, edges, potential), want / total, atol=1e-4)


# --- 7

def test_language_held_out(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(d).join(d.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in got) >= 0.98 * len(got) > 100


# --- 8

def test_extraction_of_the_pages(spark):
    import html

    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    for r in html_trees.extract_pages(pages).join(pages.select("page_id", "html"), "page_id").collect():
        body = re.sub(r"</?(p|h1|br)[^>]*>", " \x00 ", re.search(r"<article>(.*?)</article>", r.html, re.S)[1])
        want = " ".join(html.unescape(re.sub(r"<[^>]+>", "", body)).replace("\x00", " ").split())
        assert r.text == want and r.n_chars == len(want), r.page_id


def test_decoding_has_no_contradictions():
    rng = np.random.default_rng(7)
    nodes, _ = html_trees.parse("<div>a<div>b<p>c</p><div>d<p>e</p></div></div><p>f</p></div><footer>g<p>h</p></footer>")
    for _ in range(200):
        states = html_trees.decode(nodes, rng.normal(size=len(nodes)) * 3)
        for k, v in enumerate(nodes[1:], 1):
            assert states[k] in html_trees.ALLOWED[states[v.parent]]


def test_broken_markup():
    for page in ("<p>a<b", "<script>x", "</div></p>text", "<!-- open", "<a href='x>y</a>", "<ul><li>a<li>b</ul>", "<table><tr><td>x<td>y</table>", "&amp;&bogus;<br>z"):
        nodes, runs = html_trees.parse(page)
        html_trees.render(runs, [html_trees.IN] * len(nodes))
    nodes, runs = html_trees.parse("<p>a <b>b</b>c<br>d &amp; e</p><li>f<li>g<script>no</script>")
    assert html_trees.render(runs, [html_trees.IN] * len(nodes)) == "a bc d & e f g"


# --- 9

def test_quality_rule_counts(spark, docs, texts):
    rows = [*texts.items(), (9000, None), (9001, ""), (9002, "a b c a b c a b c\n\nx\nx\n \n \nx#"), (9003, "é ü\nÉ")]
    for r in perplexity_rules.judge(frame(spark, rows).withColumn("lang", F.lit("en"))).collect():
        t = dict(rows)[r.doc_id] or ""
        w = WORD.findall(t)
        windows = Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want = (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        assert r.base_failed == (len(w) < 50 or 100 * len(covered) > 50 * len(w)) and not (r.base_failed and r.kept)


def test_kneser_ney_sums_to_one():
    rng = np.random.default_rng(1)
    gram = np.unique(rng.integers(0, 1 << 20, 4000) & 0b11000111001110011100)
    m = perplexity_rules.KneserNey(gram, rng.integers(1, 9, len(gram)))
    for context in [*np.unique(gram >> 5)[:20], 12345]:
        p = m.lookup((int(context) << 5) + np.arange(32), 4)
        assert abs(p.sum() - 1) < 1e-9


def test_clean_documents_are_kept_and_noise_goes(spark):
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rng = random.Random(2)
    noise = frame(spark, [(10_000_000 + i, " ".join("".join(rng.choice("bcdfgjkqvwxz") for _ in range(7)) for _ in range(80)), "en") for i in range(5)], "doc_id long, text string, lang string")
    got = perplexity_rules.judge(d.select("doc_id", "text", "lang").unionByName(noise)).cache()
    good = got.join(labels.where("quality = 1"), "doc_id").where("not base_failed")
    assert good.where("kept").count() >= 0.98 * good.count()
    assert got.where("doc_id >= 10000000 and kept").count() == 0


def test_the_band_rejects_texts_labelled_bad(spark):
    d, labels = spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    got = perplexity_rules.judge(d.select("doc_id", "text", "lang")).join(labels, "doc_id").where("not base_failed")
    n = {r.quality: (r.n, r.kept) for r in got.groupBy("quality").agg(F.count("*").alias("n"), F.count_if("kept").alias("kept")).collect()}
    assert n[0][0] >= 10 and n[0][1] <= 0.6 * n[0][0] and n[1][1] >= 0.98 * n[1][0]


# --- 10

def brute_lines(rows):
    """Keepers by comparing all pairs of line classes as the operator defines them."""
    lines = [(d, i, x) for d, t in rows for i, x in enumerate(line_dedup.normalise((t or "").encode()).split(b"\n")) if x.split()]
    classes = {}
    for d, i, x in lines:
        w = x.split()
        classes.setdefault((b" ".join(w), d if len(w) < line_dedup.SHORT else None), []).append((d, i))
    keys = sorted(classes, key=lambda k: min(classes[k]))
    mark = {}
    for k in keys:
        if len(k[0].split()) >= line_dedup.LONG:
            w = Words([k[0]], fold=False)
            mark[k] = int(line_dedup.simhashes(w.hash, np.array([0, len(w)]))[0])
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    def edit(a, b):
        row = [*range(len(b) + 1)]
        for i, u in enumerate(a, 1):
            new = [i]
            for j, v in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (u != v)))
            row = new
        return row[-1]

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            if a in mark and b in mark and (mark[a] ^ mark[b]).bit_count() <= line_dedup.RADIUS:
                x, y = a[0].decode(), b[0].decode()
                if edit(x, y) <= math.floor(max(len(x), len(y)) * (1 - line_dedup.SIMILARITY) + 1e-9):
                    root[find(b)] = find(a)
    keeper = {}
    for k in keys:
        keeper[find(k)] = min(keeper.get(find(k), min(classes[k])), min(classes[k]))
    gone = {place for k in keys for place in classes[k] if place != keeper[find(k)]}
    return {d: None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in rows}


def test_lines_match_brute_force(spark):
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(200)]
    shared = [[rng.choice(vocabulary) for _ in range(n)] for n in (3, 6, 30, 40, 60)]
    rows = []
    for d in range(40):
        lines = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 12))) for _ in range(3)]
        for w in rng.sample(shared, 2):
            w = list(w)
            if rng.random() < 0.6:
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            lines.append(" ".join(w).capitalize() + rng.choice(["", ".", "!!"]))
        rows.append((d, "\n".join(lines + ["", "--", "Yes.", "Yes."])))
    rows += [(100, None), (101, ""), (102, "\n\n")]
    got = line_dedup.dedup_lines(frame(spark, rows)).collect()
    want = brute_lines(rows)
    assert {r.doc_id: r.text for r in got} == want
    assert all(r.n_removed == (0 if dict(rows)[r.doc_id] is None else dict(rows)[r.doc_id].count("\n") - (r.text.count("\n") if r.text or r.doc_id > 99 else -1)) for r in got if r.doc_id < 100)
    assert sum(len(t or "") for _, t in rows) > sum(len(t or "") for t in want.values())


def test_two_equal_blocks_for_any_three_bits(spark):
    rng = random.Random(5)
    pairs = []
    for i in range(300):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), 3):
            y ^= 1 << b
        pairs.append((i, *((v - (1 << 64) if v >> 63 else v) for v in (x, y))))
    df = frame(spark, pairs, "i long, x long, y long")
    assert df.where(F.size(F.array_intersect(line_dedup.block_keys(F.col("x")), line_dedup.block_keys(F.col("y")))) == 0).count() == 0
