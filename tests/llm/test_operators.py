"""Operators against brute force on small tables, with nulls, empty and long texts, ties, repeats and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from weftgraph.llm import bpe, html_text, jaccard_join, kernel, language_id, linear, nearest, packing, quality_classifier, quality_rules, secrets, sharding
from weftgraph.llm.entry import vocabulary_path
from weftgraph.plans.iterate import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string"


def documents(spark, texts, first=0):
    """Rows with columns that clash with names the operators use themselves."""
    rows = [(first + i, t, ("en", "de", None)[i % 3], "s", len(t or ""), 0.5, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefgéß日", k=rng.randint(1, 7))) for _ in range(400)]
    base = [" ".join(rng.choices(words, k=rng.randint(1, 120))) for _ in range(40)]
    near = []
    for t in base[:15]:
        for _ in range(3):
            w = t.split(" ")
            for _ in range(rng.randint(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(words)
            near.append(" ".join(w))
    odd = [None, "", " \n\t ", "a", "A b", "x " * 3000, "é" * 5000, "one\ntwo\none\n\nONE", "$#* & | <>%", base[0], base[0], base[1].upper()]
    return base + near + odd


def sets(text):
    words = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute_components(rows):
    shingles = {i: sets(t) for i, t in rows}
    parent = {i: i for i in shingles}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(shingles)
    for a in ids:
        for b in ids:
            if a < b and shingles[a] and shingles[b]:
                common = len(shingles[a] & shingles[b])
                if 100 * common >= 75 * (len(shingles[a]) + len(shingles[b]) - common):
                    x, y = find(a), find(b)
                    parent[max(x, y)] = min(x, y)
    return {i: (len(shingles[i]), find(i)) for i in ids}


def test_jaccard_join(spark, texts, monkeypatch):
    wanted = brute_components(list(enumerate(texts)))
    found = jaccard_join.join(documents(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted
    # all buckets large: the way by rarest shingles must find the same
    monkeypatch.setattr(jaccard_join, "SMALL", 1)
    found = jaccard_join.join(documents(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted


def test_jaccard_join_where_too_few_chunks_come_forward(spark, texts, monkeypatch):
    real = jaccard_join.chunks

    def short(flat, n, hot):
        name, owner, _, common = real(flat, n, hot)
        some = np.flatnonzero((n > 0) & (n % 2 == 0))
        keep = ~np.isin(owner, some)
        return name[keep], owner[keep], some, common[keep]

    rest = jaccard_join._rest_pairs
    texts = texts[:60]
    found = jaccard_join.join(documents(spark, texts)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(list(enumerate(texts)))
    # the exact way by itself: every linked pair with an even set is among its candidates
    docs = documents(spark, texts).select("doc_id", "text")
    ids = docs.select("doc_id")
    pairs = {(r.a, r.b) for r in rest(ids, docs, 5).collect()}
    for a in range(len(texts)):
        for b in range(a):
            x, y = sets(texts[a]), sets(texts[b])
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                assert (b, a) in pairs
    assert len(short(np.arange(10, dtype=np.uint64), np.array([10]), (np.zeros(0, np.uint64), np.zeros(0, np.uint64)))[2]) == 1


def test_jaccard_one_each_and_empty(spark, texts):
    rows = list(enumerate(texts))
    kept = {r.doc_id for r in jaccard_join.one_each(documents(spark, texts)).collect()}
    assert kept == {i for i, (_, c) in brute_components(rows).items() if c == i}
    assert jaccard_join.join(documents(spark, []).limit(0)).count() == 0
    nulls = spark.createDataFrame([(None, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (2, "a b c d e f")], "doc_id long, text string")
    assert sorted((str(r.doc_id), str(r.component_id)) for r in jaccard_join.join(nulls).collect()) == [("1", "1"), ("2", "1"), ("2", "1"), ("None", "None")]


def test_quality_metrics(texts):
    import pyarrow as pa

    for size in (64, 1 << 20):
        at = 0
        for first, last, data, offsets in kernel.blocks(pa.array(texts, pa.string()), size):
            got = quality_rules.metrics(data, offsets)
            for i in range(first, last):
                text = texts[i] or ""
                words = WORD.findall(text)
                windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
                covered = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
                lines = [x for x in text.split("\n") if WORD.search(x)]
                wanted = (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
                assert tuple(int(v[i - first]) for v in got.values()) == wanted
            at = last
        assert at == len(texts)


def labelled(spark):
    rng = random.Random(5)
    good = [" ".join(rng.choices(["the", "house", "was", "green", "and", "tall", "by", "river"], k=80)) for _ in range(60)]
    bad = [" | ".join(rng.choices(["BUY", "NOW", "$$$", "click", "###"], k=60)) for _ in range(60)]
    docs = documents(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i < 60), 0) for i in range(120)] + [(5, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_quality_models(spark, texts):
    docs, labels = labelled(spark)
    found = quality_classifier.classify(docs, labels).toPandas().set_index("doc_id")
    held = found[found.held_out]
    assert ((held.predicted == 1) == (held.index < 60)).all()
    assert all(bool(found.held_out[i]) == (zlib.crc32(str(i).encode()) % 3 == 1) for i in range(120))
    weights = quality_classifier.fit(docs, labels)
    odd = quality_classifier.score(documents(spark, texts), weights).toPandas().set_index("doc_id").score
    assert odd.between(0, 1).all() and odd[texts.index(None)] == 0 and odd[texts.index("")] == 0
    kept = quality_rules.passing(docs, quality_rules.fit(docs, labels))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} <= set(range(60))
    none = quality_rules.judge(docs, labels.limit(0)).collect()
    assert all(r.kept != r.base_failed for r in none)
    assert quality_classifier.classify(docs.limit(0), labels).count() == 0


def test_ftrl_equals_scalar_updates():
    """The updates of a pass against the per-coordinate rule written out with numbers and dictionaries."""
    rng = random.Random(6)
    alpha, beta, l1, l2 = 0.5, 1.0, 0.002, 0.1
    rows = []
    for _ in range(60):
        idx = np.array(sorted(rng.sample(range(40), rng.randint(1, 9))))
        rows.append((idx, np.array([rng.random() for _ in idx]), float(rng.random() < 0.5)))
    z, n = np.zeros(41), np.zeros(41)
    linear.ftrl_pass(rows, z, n, alpha, beta, l1, l2)
    zs, ns = {}, {}

    def weight(i):
        v = zs.get(i, 0.0)
        return 0.0 if abs(v) <= l1 else -(v - (l1 if v > 0 else -l1)) / ((beta + ns.get(i, 0.0) ** 0.5) / alpha + l2)

    for idx, value, label in rows:
        w = {i: weight(i) for i in idx.tolist()}
        p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in zip(idx.tolist(), value.tolist()))))
        for i, v in zip(idx.tolist(), value.tolist()):
            g, before = (p - label) * v, ns.get(i, 0.0)
            zs[i] = zs.get(i, 0.0) + g - ((before + g * g) ** 0.5 - before**0.5) / alpha * w[i]
            ns[i] = before + g * g
    assert np.allclose([zs.get(i, 0.0) for i in range(41)], z) and np.allclose([ns.get(i, 0.0) for i in range(41)], n)
    assert np.allclose(linear.weights_of(z, n, alpha, beta, l1, l2), [weight(i) for i in range(41)])


def test_verdicts_by_hand(spark, texts):
    """Probabilities and verdicts of the quality rules from their definition, text by text."""
    docs, labels = labelled(spark)
    model = quality_rules.fit(docs, labels)
    found = {r.doc_id: r for r in quality_rules.apply(documents(spark, texts), model).collect()}
    for i, text in enumerate(texts):
        data = np.frombuffer((text or "").encode(), np.uint8)
        idx, value = next(linear.vectors(linear.word_char_features(data, np.array([0, len(data)]))))
        p = 1 / (1 + np.exp(-(model.slope * (float(model.weights[idx] @ value) + model.weights[-1]) + model.offset)))
        assert abs(found[i].probability - p) < 1e-4
        if abs(p - quality_rules.THRESHOLD) > 1e-3:
            assert found[i].kept == (not found[i].base_failed and p >= quality_rules.THRESHOLD)
    # the probability scale: Platt's two parameters are where the softened likelihood is stationary
    rng = np.random.default_rng(3)
    decision = rng.normal(size=300)
    label = (rng.random(300) < 1 / (1 + np.exp(-2 * decision + 0.5))).astype(float)
    slope, offset = quality_rules._platt(decision, label)
    target = np.where(label > 0, (label.sum() + 1) / (label.sum() + 2), 1 / (300 - label.sum() + 2))
    p = 1 / (1 + np.exp(-(slope * decision + offset)))
    assert abs((p - target).sum()) < 1e-3 and abs(((p - target) * decision).sum()) < 1e-3
    assert quality_rules.judge(docs.limit(0), labels).count() == 0


def test_dot_equals_training_vectors(texts):
    import pyarrow as pa

    weights = np.random.default_rng(0).normal(size=linear.DIMENSIONS)
    for featurise in (linear.token_features, linear.word_char_features):
        for _, _, data, offsets in kernel.blocks(pa.array(texts, pa.string())):
            families = featurise(data, offsets)
            wanted = [weights[i] @ v for i, v in linear.vectors(families)]
            assert np.allclose(linear.dot(families, weights), wanted)


def test_language_id(spark):
    rng = random.Random(8)
    speak = lambda letters: " ".join("".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(40))
    rows = [(i, speak("abcde" if i % 2 else "vwxyzäö"), "en" if i % 2 else "de") for i in range(90)] + [(900, None, "en"), (901, "123 !!", "de"), (902, "", None), (903, "abc", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in language_id.identify(docs).collect()}
    assert all(found[i].lang_pred == ("en" if i % 2 else "de") for i in range(90))
    assert [found[i].lang_pred for i in (900, 901, 902, 903)] == ["und", "und", "und", "en"] and found[901].score == 0
    assert {r.doc_id for r in language_id.passing(docs, language_id.fit(docs)).collect()} == {*range(90), 903}
    assert {r.lang_pred for r in language_id.identify(docs.where("lang IS NULL")).collect()} == {"und"}


def test_language_costs_are_code_lengths(spark, monkeypatch):
    """Bits of texts equal those of a byte-by-byte coder with dictionaries, for languages in one group and in many."""
    rng = random.Random(18)
    speak = lambda letters, n: "".join(rng.choices(letters, k=n))
    rows = [(i, speak("abc é", 60) if i % 2 else speak("xyz b", 60), "a" if i % 2 else "b") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = {lang: [{} for _ in range(4)] for lang in "ab"}
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 3 == 1:
            continue
        raw = b"\0\0\0" + text.encode()
        for at in range(3, len(raw)):
            for k in range(4):
                table = counts[lang][k].setdefault(raw[at - k : at], Counter())
                table[raw[at]] += 1

    def cost(lang, context, byte):
        p = 1 / 256
        for k in range(4):
            table = counts[lang][k].get(context[3 - k :])
            if table:
                p = (table[byte] + len(table) * p) / (table.total() + len(table))
        return -np.log2(p)

    import pyarrow as pa

    texts = ["abc cab é", "zzz", "", "ab xy ÿ~ 日本", "b" * 50, None]
    for size in (1, 16):
        monkeypatch.setattr(language_id, "GROUP", size)
        model = language_id.fit(docs)
        for _, _, data, offsets in kernel.blocks(pa.array(texts, pa.string())):
            for trees in model:
                got = language_id.code_lengths(trees, data, offsets)
                for i, text in enumerate(texts):
                    raw = b"\0\0\0" + (text or "").encode()
                    for j, lang in enumerate(trees.languages):
                        wanted = sum(cost(lang, raw[at - 3 : at], raw[at]) for at in range(3, len(raw)))
                        assert abs(got[i, j] - wanted) < 1e-3 * max(1, wanted)


def test_language_groups_agree(spark, monkeypatch):
    rng = random.Random(28)
    alphabets = {f"l{k:02d}": "".join(chr(97 + (k * 5 + j) % 26) for j in range(6)) + " " for k in range(20)}
    rows = [(i, "".join(rng.choices(alphabets[lang], k=80)), lang) for i, lang in enumerate(lang for lang in alphabets for _ in range(4))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    one = {r.doc_id: (r.lang_pred, round(r.score, 6)) for r in language_id.identify(docs).collect()}
    monkeypatch.setattr(language_id, "GROUP", 3)
    assert {r.doc_id: (r.lang_pred, round(r.score, 6)) for r in language_id.identify(docs).collect()} == one


def test_language_stage_drops_what_was_not_learned(spark):
    rng = random.Random(38)
    speak = lambda letters: " ".join("".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(80))
    rows = [(i, speak("abcde" if i % 2 else "vwxyz"), "en" if i % 2 else "de") for i in range(60)]
    rows += [(100, speak("αβγδεζηθ"), None), (101, "".join(rng.choices([chr(c) for c in range(33, 127)], k=600)), None), (102, speak("abcde"), None)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, lang string, letters int, score string")
    kept = language_id.passing(docs, language_id.fit(docs))
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {*range(60), 102}
    assert language_id.passing(docs.limit(0), language_id.fit(docs.limit(0))).count() == 0


def test_bpe(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    long = "".join(random.Random(4).choice(["some ", "wörds ", "日本。", "it's\n", "  "]) for _ in range(700_000))
    assert len(long.encode()) > 3 * bpe.BLOCK
    more = texts + [long, "it's they'll 'S ''s <|endoftext|> a\n\n  b\t c  ", "<|endoftext|", "ab" * 4000, "x" * 3000 + " y", "　  z "]
    found = {r.doc_id: r for r in bpe.round_trip(documents(spark, more), vocabulary_path()).collect()}
    for i, text in enumerate(more):
        ids = library.encode(text or "", add_special_tokens=False).ids
        assert found[i].n_tokens == len(ids)
        assert found[i].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert found[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_pretokens_of_all_code_points():
    """Every assigned code point after a letter, a digit and a sign, and before a contraction, is cut as by the library."""
    from tokenizers import pre_tokenizers

    library = pre_tokenizers.ByteLevel(add_prefix_space=False)
    points = [chr(c) for c in [*range(0xD800), *range(0xE000, 0x34000), *range(0xE0000, 0xE0200)]]
    for at in range(0, len(points), 30_000):
        text = "".join(f"a{c}1{c}!{c}'s  {c}\n" for c in points[at : at + 30_000])
        data = np.frombuffer(text.encode(), np.uint8)
        widths = np.fromiter((len(c.encode()) for c in text), np.int64, len(text))
        byte_of = np.concatenate(([0], np.cumsum(widths)))
        wanted = byte_of[[a for _, (a, _) in library.pre_tokenize_str(text)]]
        assert np.array_equal(bpe.pretokens(data, np.array([0, len(data)]), [])[:-1], wanted)


def test_long_texts_go_through_windows():
    coder = bpe.encoder(bpe.spec_of(vocabulary_path()))
    rng = random.Random(12)
    text = "".join(rng.choice(["it's ", "wörd ", "  ", "\n\n", "日本語。", "x" * 300, "'ll", "!?'", "12 ", "<|endoftext|>", "\u3000 ", "é"]) for _ in range(4000))
    data = np.frombuffer(text.encode(), np.uint8)
    whole = coder.encode(data, np.array([0, len(data)]))[0]
    for size in (64, 257, 5000):
        assert np.array_equal(np.concatenate([*coder.windows(data, size)]), whole)


def test_transducer_windows_and_decoder():
    vocabulary = bpe.Vocabulary(bpe.spec_of(vocabulary_path()))
    look = vocabulary.lookahead()
    rng = random.Random(2)
    words = ["".join(rng.choices(letters, k=rng.randint(1, 3000))).encode() for letters in ("ab", "etaoinshrdlu", "aA1", "é日", "=", "theing") for _ in range(6)]
    whole, parts = bpe.merge(vocabulary, words), bpe.transduce(vocabulary, words, look, window=16)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()
    raw = "é日\ud83d".encode("utf-8", "surrogatepass") + b"\xff a"
    assert "".join(bpe.decode(raw[i : i + 1] for i in range(len(raw)))) == raw.decode("utf-8", "replace")


def test_packing(spark, texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary_path())
    found = packing.best_fit(documents(spark, texts), vocabulary_path(), capacity=64).toPandas()
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        mine = found[found.doc_id == i].sort_values("piece")
        assert list(mine.piece) == list(range(-(-len(ids) // 64))) and mine.length.sum() == len(ids) and (mine.length.iloc[1:] == 64).all()
        assert all(zlib.crc32(ids[s : s + n].tobytes()) == c for s, n, c in zip(mine.start, mine.length, mine.ids_crc32))
    used = 0
    for _, part in found.sort_values("offset").groupby("sequence_id"):
        assert list(part.offset) == [0, *np.cumsum(part.length)[:-1]] and part.length.sum() <= 64
        used += 1
    wanted = sequential_best_fit(list(found.length), 64)
    assert used <= wanted + 1 + wanted // 50 and sorted(found.sequence_id.unique()) == list(range(used))
    assert packing.best_fit(documents(spark, []).limit(0), vocabulary_path()).count() == 0


def sequential_best_fit(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        gap = min(fit) if fit else capacity
        if fit:
            gaps.remove(gap)
        gaps.append(gap - n)
    return len(gaps)


def placed_by_supersteps(lengths, capacity):
    """The sequences that supersteps fill: lists of (offset, length); every piece exactly once."""
    state = [(packing.LEFT, k, 0, n, 0, 0, 0) for k, n in Counter(lengths).items()]
    while any(row[0] == packing.LEFT for row in state):
        state = packing.swept(state, capacity)
    sequences, ranks = {}, Counter()
    for _, length, rank, n, sequence, each, offset in (row for row in state if row[0] == packing.PLACED):
        for i in range(n):
            ranks[length, rank + i] += 1
            sequences.setdefault(sequence + i // each, []).append((offset + i % each * length, length))
    assert ranks == Counter((k, r) for k, n in Counter(lengths).items() for r in range(n))
    return sequences


def test_supersteps_against_sequential_best_fit():
    rng = random.Random(1)
    for _ in range(80):
        capacity = rng.choice((1, 7, 50, 64, 2048))
        lengths = [min(rng.randint(1, capacity), rng.randint(1, capacity)) for _ in range(rng.randint(0, 400))]
        sequences = placed_by_supersteps(lengths, capacity)
        for row in sequences.values():
            row.sort()
            assert [at for at, _ in row] == [0, *np.cumsum([n for _, n in row])[:-1]] and sum(n for _, n in row) <= capacity
        wanted = sequential_best_fit(lengths, capacity)
        assert len(sequences) <= wanted + 1 + wanted // 50


def test_secrets(spark, texts):
    secret = "ab" * 14
    more = texts + [f'é password = "abc/+9" token:x secret:token:abcdefgh {secret} AKIA{"Z9" * 9} API_key=1234567', "AKIASHORT", "deadbeef", "PASSWD:" + "q" * 50, "-----BEGIN RSA PRIVATE KEY-----"]
    found = {r.doc_id: r for r in secrets.report(documents(spark, more)).collect()}
    rules = (("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), 2, 6), ("access", re.compile("AKIA[A-Z0-9]+"), 0, 20), ("hex", re.compile("[0-9a-f]+"), 0, 24))
    for i, text in enumerate(more):
        spans = [(m.start(), k, name, m.end()) for k, (name, p, g, least) in enumerate(rules) for m in p.finditer(text or "") if len(m[g]) >= least]
        wanted = ",".join(f"{name}:{a}:{b}" for a, _, name, b in sorted(spans))
        assert found[i].base_sha256 == hashlib.sha256(wanted.encode()).hexdigest()
        assert (found[i].n_assign, found[i].n_access, found[i].n_hex) == tuple(sum(s[1] == k for s in spans) for k in range(3))
    assert found[len(more) - 1].spans.startswith("pem:0:")
    clean = {r.doc_id: r for r in secrets.redacted(documents(spark, more)).collect()}
    k = len(texts)
    assert secret not in clean[k].text and clean[k].text.startswith("é [REDACTED]") and clean[k].n_chars == len(clean[k].text)
    assert clean[0].text == more[0] and clean[texts.index(None)].text is None


def test_ledger_over_two_runs(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    docs = documents(spark, ["token=abcdef", "token=abcdef", "nothing", None])
    first = secrets.scanned(docs, ledger)
    assert first.count() == 3 and secrets.unseen(docs, first).count() == 0
    wanted = secrets.report(docs, ledger=ledger).collect()
    assert {r.doc_id: r.spans for r in wanted} == {0: "assign:0:12", 1: "assign:0:12", 2: "", 3: ""}
    assert secrets.read_ledger(docs, ledger).count() == 3  # the second run had nothing to scan
    # a third run meets one new text and one new rule; what earlier runs found is joined to all documents with that content
    newer = (*secrets.RULES, secrets.Rule("word", 1, "nothing", 0, 1, base=False))
    more = documents(spark, ["token=abcdef", "nothing", "secret: 1234567"], first=10)
    todo = {r.text: r.todo for r in secrets.unseen(more, secrets.read_ledger(docs, ledger), newer).collect()}
    assert todo["nothing"] == ["word/1"] and todo["token=abcdef"] == ["word/1"] and len(todo["secret: 1234567"]) == len(newer)
    found = {r.doc_id: r.spans for r in secrets.report(more, newer, ledger).collect()}
    assert found == {10: "assign:0:12", 11: "word:0:7", 12: "assign:0:15"}
    assert {r.doc_id: r.spans for r in secrets.report(docs, ledger=ledger).collect()} == {0: "assign:0:12", 1: "assign:0:12", 2: "", 3: ""}


def test_redaction_keeps_columns_of_any_name(spark):
    key = "-----BEGIN RSA PRIVATE KEY-----\nabc-def\nMII\n-----END RSA PRIVATE KEY-----"
    rows = [(1, f"x {key} y", 0, "mine", "a"), (2, "clean", 5, "own", "b"), (None, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, blob string, found string")
    out = secrets.redacted(docs)
    assert out.columns == docs.columns
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, "x [REDACTED] y", 14, "mine", "a"), *rows[1:]], key=str)
    assert secrets.report(docs.limit(0)).count() == 0 and secrets.redacted(docs.limit(0)).count() == 0


def test_sharding(spark, texts):
    many = texts + ["copy of a text"] * 300
    found = sharding.shard(documents(spark, many)).toPandas().set_index("doc_id")
    assert len(found) == len(many) and all(sorted(x) == list(range(len(x))) for _, x in found.groupby("shard").slot)
    for i, text in enumerate(many):
        raw = (text or "").encode()
        assert (found["size"][i], found.text_crc32[i]) == (len(raw) + 1, zlib.crc32(raw))
    per = found.groupby("shard")["size"].sum()
    largest = found["size"].max()
    assert found.shard.between(0, 15).all() and per.max() <= per.sum() / 16 + 2 * largest
    # one text very often, and many pairs: no small group is torn, and shards stay nearly equal
    rng = random.Random(9)
    pairs = ["".join(rng.choices("abc ", k=rng.randint(20, 60))) for _ in range(4000)]
    many = ["often"] * 2000 + pairs + pairs
    found = sharding.shard(documents(spark, many)).toPandas().set_index("doc_id")
    found["text"] = [many[i] for i in found.index]
    assert (found[found.text != "often"].groupby("text").shard.nunique() == 1).all()
    per = found.groupby("shard")["size"].sum()
    assert per.max() - per.min() <= 4 * 62 and all(sorted(x) == list(range(len(x))) for _, x in found.groupby("shard").slot)
    assert sharding.shard(documents(spark, []).limit(0)).count() == 0


def test_nearest(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 8)) * 3
    v = centres[rng.integers(12, size=1500)] + rng.normal(size=(1500, 8))
    v[700:900] = v[700]  # a group of equal vectors
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)] + [(2000, None), (2100, []), (2200, [0.0] * 8), (2300, [float("nan")] * 8), (2400, [None] + [1.0] * 7), (2500, [1.0, 2.0]), (None, [1.0] * 8), (3, [float(x) for x in v[3]])]
    found = nearest.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).toPandas()
    assert set(found.query_id) == set(range(0, 1500, 100))
    hit = 0
    for q, part in found.groupby("query_id"):
        d = np.sqrt(((v - v[q]) ** 2).sum(1))
        order = [i for i in np.lexsort((np.arange(1500), d)) if i != q][:10]
        part = part.sort_values("rank")
        assert list(part["rank"]) == list(range(1, 11)) and np.allclose(part.score, d[part.vec_id])
        assert list(zip(part.score, part.vec_id)) == sorted(zip(part.score, part.vec_id))
        hit += len(set(order) & set(part.vec_id))
    assert hit >= 0.9 * 150
    few = nearest.search(spark.createDataFrame(rows[:3], "vec_id long, embedding array<double>")).toPandas()
    assert list(few.vec_id) and len(few) == 2
    assert nearest.search(spark.createDataFrame([], "vec_id long, embedding array<double>")).count() == 0


def test_nearest_with_many_lists(spark, monkeypatch):
    """Recall where lists are many more than ``MOST``, over directions that hardly differ in variance."""
    monkeypatch.setattr(nearest, "LIST", 16)
    n = 12_000
    v = np.random.default_rng(6).normal(size=(n, 32))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    assert n // nearest.LIST > 10 * nearest.MOST
    rows = spark.createDataFrame([(i, x) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<double>").repartition(4)
    found = nearest.search(rows).toPandas()
    hit = 0
    for q, part in found.groupby("query_id"):
        d = np.sqrt(((v - v[q]) ** 2).sum(1))
        hit += len(set(np.argsort(d, kind="stable")[1:11]) & set(part.vec_id))
    assert found.query_id.nunique() == 120
    assert hit >= 0.9 * 1200


def test_html(spark):
    page = """<html><head><title>x</title><style>p{}</style></head><body><header>Site</header><nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies on this page and all others here.</div>
    <article><h1>A  title</h1><p>First &amp; second&nbsp;part<br>third.</p><p>Of.</p><script>var a = "</p><p>no";</script><div class="comments"><p>Nice article, thank you very much for it.</p></div><p>Last <b>bold</b> &#233;</p></article>
    <aside>Other things to read</aside><form><label>Name</label></form><footer>&copy; x</footer>"""
    rows = [(1, "u", page), (2, "v", None), (3, None, ""), (4, "w", "<div"), (5, "x", "<p>" + "long text here " * 5000), (1, "u", page), (None, None, None)]
    found = html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    by = {r.page_id: r for r in found}
    assert len(found) == 7 and by[1].text == "A title\nFirst & second part\nthird.\nOf.\nLast bold é" and by[1].n_chars == len(by[1].text)
    assert by[2].text == by[3].text == by[4].text == "" and by[5].n_chars == 15 * 5000 - 1
    assert html_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string").limit(0)).count() == 0
    tree = html_text.fit()
    table = np.array(html_text.LABELLED, float)
    assert (html_text.keeps(tree, table[:, :-1]) == table[:, -1]).mean() >= 0.95


def test_html_names_are_hints_only():
    body = "A paragraph of some length that says what there is to say about the matter and then some more."
    keep = ("side-by-side", "lead share", "text", "article-header")
    drop = ("comments", "cookie-notice", "sidebar", "ad", "share", "ad-slot", "newsletter-signup", "related")
    inner = "".join(f'<div class="{name}"><p>{body} {name}.</p></div>' for name in keep + drop)
    page = f'<body><article><h1>Title</h1><section id="related-work"><h2>Related</h2><p>Short.</p></section>{inner}<p>End.</p></article></body>'
    assert html_text.main_text(page, html_text.fit()) == "\n".join(["Title", "Related", "Short.", *(f"{body} {name}." for name in keep), "End."])


def test_html_pages_without_an_article():
    """Random pages, with the main text known from how they were made: headings and short paragraphs beside text stay."""
    rng = random.Random(21)
    tree = html_text.fit()
    say = lambda a, b: " ".join("".join(rng.choices("abcdefgh", k=rng.randint(2, 8))) for _ in range(rng.randint(a, b)))
    for _ in range(200):
        menu = "".join(f'<li><a href="/{k}">{say(1, 3)}</a></li>' for k in range(rng.randint(3, 8)))
        wanted, parts = [], []
        for k in range(rng.randint(2, 5)):
            for tag, text in ((f"h{rng.randint(1, 3)}", say(2, 7)), ("p", say(2, 6)), ("p", say(20, 90)), ("p", say(1, 5)), ("p", say(15, 60))):
                if tag == "p" or k == 0 or rng.random() < 0.6:
                    parts.append(f"<{tag}>{text}</{tag}>")
                    wanted.append(text)
        side = f'<div class="sidebar"><h3>{say(1, 3)}</h3><p>{say(5, 30)}</p></div>'
        notice = f'<div id="cookie-banner"><p>{say(5, 20)}</p><button>OK</button></div>'
        page = f'<html><head><title>{say(2, 6)}</title></head><body>{notice}<ul class="main-menu">{menu}</ul><div class="{rng.choice(["content", "post", "entry text"])}">{"".join(parts)}</div>{side}<footer>{say(3, 12)}</footer></body></html>'
        assert html_text.main_text(page, tree) == "\n".join(wanted)


def test_language_sample_is_the_same_without_broadcast(spark, monkeypatch):
    rows = [(i, f"text {i} of some words", "xyz"[i % 3]) for i in range(90)] + [(4, "text 4 again", "x"), (5, None, "y"), (None, "t", "z"), (6, "t", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    counts = lambda: sorted(tuple(r) for r in language_id.gather(frame, 12).collect())
    sent = counts()
    monkeypatch.setattr(language_id, "SENT", 0)
    assert counts() == sent and sent


def test_workers_drop_what_earlier_stages_keep(spark):
    """A stage without an encoder runs in workers that have one; it leaves neither that nor freed memory behind."""
    docs = spark.createDataFrame([(i, f"words number {i} of text") for i in range(8)], "doc_id long, text string").repartition(4)

    def seen(batches):
        for batch in batches:
            with open("/proc/self/smaps_rollup") as f:
                mb = sum(int(line.split()[1]) for line in f if line.startswith("Pss_Anon")) // 1024
            yield pa.RecordBatch.from_arrays([pa.array([",".join(kernel.KEPT)] * batch.num_rows), pa.array([mb] * batch.num_rows)], ["kept", "mb"])

    def wasteful(batches):
        for batch in batches:
            held = [np.ones(1000) for _ in range(25_000)]  # 200 MB in small pieces; something small above them stays
            np.held_by_the_test = np.ones(1000)
            del held
            yield batch.select(["doc_id"])

    look = lambda: docs.mapInArrow(seen, "kept string, mb long").collect()
    bpe.round_trip(docs, vocabulary_path()).collect()
    assert {r.kept for r in look()} == {"bpe"}
    quality_rules.passing(docs, quality_rules.Model(np.zeros(linear.DIMENSIONS + 1, np.float32), 1.0, 0.0, False)).collect()
    assert {r.kept for r in look()} == {""}
    assert docs.mapInArrow(kernel.frugal(wasteful), "doc_id long").count() == 8
    assert max(r.mb for r in look()) < 200


def test_labels_of_earlier_links_are_not_made_anew(spark):
    """New links are joined to labels that stand: the same components as of all links, in fewer jobs."""
    make = lambda links: spark.createDataFrame(links, "a long, b long")
    chain, new = [(i, i + 1) for i in range(200)], [(500, 150), (500, 501), (700, 701), (700, 702)]
    known = components(make(chain))
    seen, jobs = {}, {}
    for name, arguments in {"anew": (make(chain + new),), "joined": (make(new), known)}.items():
        spark.sparkContext.setJobGroup(name, name)
        seen[name] = {(r.v, r.c) for r in components(*arguments).collect()}
        jobs[name] = len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    spark.sparkContext.setJobGroup("", "")
    assert seen["joined"] == seen["anew"] == {(v, 0) for v in [*range(201), 500, 501]} | {(v, 700) for v in (700, 701, 702)}
    assert 0 < jobs["joined"] < jobs["anew"]


def test_jaccard_join_takes_few_jobs(spark):
    """A chain of near copies beside pairs: rows are counted as they are written, and labels stand from turn to turn."""
    chain = [" ".join(f"w{i}" for i in range(5 * k, 5 * k + 80)) for k in range(30)]
    pairs = [f"{' '.join(f'p{k}x{i}' for i in range(60))} {end}" for k in range(10) for end in ("one", "two")]
    texts = chain + pairs
    docs = documents(spark, texts)
    spark.sparkContext.setJobGroup("join", "join")
    found = jaccard_join.join(docs).collect()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("join"))
    spark.sparkContext.setJobGroup("", "")
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute_components(list(enumerate(texts)))
    assert 0 < jobs < 165, jobs
