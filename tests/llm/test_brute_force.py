"""Operators and queries against plain versions of the same definitions."""

import re
import zlib
from collections import Counter, defaultdict
from math import log10
from random import Random

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

from test_copies import plain_roots

from linewarden.llm import automaton, families, ftrl, latent, ledger, pieces, pseudonym, simhash, spread, tokens
from linewarden.llm.oracle import LLM_ORACLE
from linewarden.llm.queries import LLM_QUERIES

DATA = "/root/testdata/sf0.001"
WORDS = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents():
    table = pq.read_table(f"{DATA}/documents.parquet")
    return dict(zip(table.column("doc_id").to_pylist(), table.column("text").to_pylist(), strict=True))


def plain_fingerprint(text):
    words = WORDS.findall(text.encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def plain_components(values):
    """Smallest id reachable over pairs at most two bits apart."""
    root = {i: i for i in values}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(values)
    for n, i in enumerate(ids):
        for j in ids[n + 1 :]:
            if (values[i] ^ values[j]).bit_count() <= 2:
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return {i: top(i) for i in ids}


def test_simhash_query(spark, documents):
    values = {i: plain_fingerprint(t) for i, t in documents.items()}
    roots = plain_components(values)
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in LLM_QUERIES["op3_simhash"](spark, DATA).collect()}
    assert found == {i: (f"{v:016x}", roots[i]) for i, v in values.items()}


def test_simhash_chains(spark):
    """Long chains, dense balls and single values, with the sign bit in play."""
    random = Random(3)
    values, value = [], random.getrandbits(64)
    for _ in range(60):
        values.append(value)
        value ^= 1 << random.randrange(64) | 1 << random.randrange(64)
    values += [values[0] ^ (1 << k) for k in range(64)] + [random.getrandbits(64) for _ in range(40)]
    values = list(dict.fromkeys(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    prints = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    found = {r.node: r.root for r in simhash.components(simhash.links(prints)).collect()}
    roots = plain_components(dict(enumerate(values)))
    groups = defaultdict(set)
    for i, root in roots.items():
        groups[root].add(signed[i])
    assert {frozenset(g) for g in groups.values() if len(g) > 1} == {
        frozenset(k for k, r in found.items() if r == root) for root in set(found.values())
    }
    assert all(root == min(k for k, r in found.items() if r == root) for root in found.values())


def test_automaton_query(spark, documents, monkeypatch):
    monkeypatch.setattr(automaton, "BLOCK_DOCS", 30)
    monkeypatch.setattr(automaton, "LANE", 16)
    texts = {i: [*WORDS.findall(t.encode().lower()), b"</end>"] for i, t in documents.items()}
    training = [i for i in texts if zlib.crc32(str(i).encode()) % 7 != 2]
    single, double = Counter(), Counter()
    for i in training:
        single.update(texts[i])
        double.update(zip(texts[i], texts[i][1:], strict=False))
    n, v = sum(single.values()), len(single)
    for r in LLM_QUERIES["op6_automaton"](spark, DATA).collect():
        words, base, score = texts[r.doc_id], 0.0, 0.0
        for k, w in enumerate(words):
            p = (single[w] + 1) / (n + v + 1)
            base += log10(p)
            if k and single[words[k - 1]]:
                p = automaton.MIX * double[words[k - 1], w] / single[words[k - 1]] + (1 - automaton.MIX) * p
            score += log10(p)
        assert (r.n_tokens, r.train_tokens) == (len(words), n)
        assert r.n_known == sum(single[w] > 0 for w in words)
        assert r.base_score == pytest.approx(base, abs=1e-6) and r.score == pytest.approx(score, abs=1e-6)
        assert r.held_out == (r.doc_id not in training)


def test_ledger_query(spark, documents):
    for r in LLM_QUERIES["op2_ledger"](spark, DATA).collect():
        text = documents[r.doc_id]
        words = [w.decode() for w in WORDS.findall(text.encode())]
        windows = list(zip(words, words[1:], words[2:], strict=False))
        times = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
        lines = [x for x in text.split("\n") if WORDS.search(x.encode())]
        assert (r.n_words, r.word_chars, r.n_repeat_words) == (len(words), sum(map(len, words)), len(covered))
        assert (r.n_symbols, r.n_dup_lines) == (sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)))
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        assert r.base_failed == failed and not (failed and r.kept)


def test_ledger_keeps_quality(spark):
    good = pq.read_table(f"{DATA}/labels.parquet").to_pydict()
    quality = dict(zip(good["doc_id"], good["quality"], strict=True))
    rows = [r for r in LLM_QUERIES["op2_ledger"](spark, DATA).collect() if r.doc_id in quality and not r.base_failed]
    right = sum(r.kept == (quality[r.doc_id] == 1) for r in rows)
    assert right >= 0.97 * len(rows)


def test_spread_lines(spark):
    random = Random(5)
    pool = [f"line number {k} with some words" for k in range(30)]
    rows = []
    for i in range(300):
        own = [f"own {i} {k} {'text ' * 9}" for k in range(4)] + random.sample(pool, 2) + ["  rare  "] * (i < 3)
        random.shuffle(own)
        rows.append((i, "\n".join(own), random.choice([None, *"abcdefghijkl"])))
    copy = "\n".join(f"copied paragraph {k} {'word ' * 9}" for k in range(5))
    rows += [(1000 + k, copy, f"s{k}") for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in spread.without_boilerplate(docs).collect()}
    sites, first = defaultdict(set), {}
    for i, text, site in rows:
        for line in filter(None, (x.strip() for x in text.split("\n"))):
            sites[line].add(site)
            first[line] = min(i, first.get(line, i))
    for i, text, _ in rows:
        lines = text.split("\n")
        cut = {x for x in map(str.strip, lines) if x and len(sites[x]) >= spread.MIN_SITES and first[x] < i}
        share = sum(len(x.strip()) for x in lines if x.strip() in cut) / sum(len(x.strip()) for x in lines)
        kept = [x for x in lines if share > spread.MOST_REMOVED or x.strip() not in cut]
        assert found[i].text == "\n".join(kept) and found[i].lines_removed == len(lines) - len(kept)
    assert sum(r.lines_removed for r in found.values()) > 200 and found[1005].text == copy


def test_exact_counts_settle_near_estimates(spark):
    rows = [(i, f"line {n}", f"site{i}") for n in range(2, 12) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.line: r.sites for r in spread.spread_lines(spread.line_table(docs), 7).collect()}
    assert sorted(found.values()) == [7, 8, 9, 10, 11]


def test_decontamination(spark, documents):
    items = pq.read_table(f"{DATA}/benchmark.parquet").to_pydict()
    random = Random(9)
    clean = [t for t in documents.values() if len(t.split()) > 150][:60]
    planted, rows = set(), []
    for k, (item, text) in enumerate(zip(items["item_id"], items["text"], strict=True)):
        words, around = text.split(), clean[k % len(clean)].split()
        changed = [w for w in words if random.random() > 0.1]
        for at, body in ((k, words), (500 + k, changed)):
            place = random.randrange(len(around))
            rows.append((at, " ".join([*around[:place], *body, *around[place:]])))
            planted.add((at, item))
    docs = spark.createDataFrame(rows + [(i + 10_000, t) for i, t in documents.items()], "doc_id long, text string")
    bench = spark.read.parquet(f"{DATA}/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in latent.contaminated(docs, bench).collect()}
    exact = {p for p in planted if p[0] < 500}
    assert exact <= found
    dropped = planted - exact
    assert len(dropped & found) >= 0.9 * len(dropped)
    norm = lambda t: " " + " ".join(re.findall(r"[^\W_]+", t.lower())) + " "
    whole = [(i, norm(t)) for i, t in zip(items["item_id"], items["text"], strict=True)]
    true = {(d, i) for d, t in rows for i, w in whole if w in norm(t)} | planted
    true |= {(d + 10_000, i) for d, t in documents.items() for i, w in whole if w in norm(t)}
    # the texts around may hold items of their own
    assert len(found - true) <= 0.02 * len(found)


def test_recall_with_a_basis_from_few_items(spark, monkeypatch):
    """Against a brute-force subsequence search, with the SVD fitted on a tenth of 400 items."""
    monkeypatch.setattr(latent, "SAMPLE_ITEMS", 40)
    random = Random(31)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "ne", "pu", "ra", "si") for b in ("bar", "den", "fig", "gol", "hum", "jan", "kor")]
    vocabulary += [f"rare{k}" for k in range(600)]
    draw = lambda n: [random.choice(vocabulary) for _ in range(n)]
    items = {i: draw(random.randrange(18, 60)) for i in range(400)}
    docs = {}
    for i, words in items.items():
        changed = [w for w in words if random.random() > 0.12]
        around = draw(200)
        docs[i] = around[:90] + changed + around[90:]
    docs |= {1_000 + k: draw(250) for k in range(150)}
    spread = lambda d: [(i, " ".join(w)) for i, w in d.items()]
    found = latent.contaminated(
        spark.createDataFrame(spread(docs), "doc_id long, text string"), spark.createDataFrame(spread(items), "item_id long, text string")
    )
    found = {(r.doc_id, r.item_id) for r in found.collect()}
    true = set()
    for i, words in items.items():
        places, n = latent.bit_places(words), len(words)
        for d, text in docs.items():
            if len(set(words) & set(text)) * 2 < len(set(words)):
                continue
            reach = range(0, len(text), 4)
            if max(latent.common_length(places, n, text[at : at + n]) for at in reach) >= latent.COMMON * n:
                true.add((d, i))
    assert len(true) > 300 and len(true & found) >= 0.9 * len(true)
    assert not {d for d, _ in found if d >= 1_000}


def test_blocks_of_items_give_the_same(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    whole = {(r.doc_id, r.item_id) for r in latent.contaminated(docs, items).collect()}
    monkeypatch.setattr(latent, "BLOCK_ITEMS", 15)
    assert {(r.doc_id, r.item_id) for r in latent.contaminated(docs, items).collect()} == whole and whole


def test_common_length():
    random = Random(2)
    for _ in range(200):
        a, b = ([random.randrange(5) for _ in range(random.randrange(1, 15))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert latent.common_length(latent.bit_places(a), len(a), b) == table[-1, -1]


def test_pieces_equal_the_library(documents):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=pieces.MODEL)
    random = Random(4)
    odd = [" ", "  a  b\n c ﬁ ① x ", "▁a ▁▁ b", " " * 40 + "x" + " " * 33, "日本語 🎉🎉 naïve", "a" * 300, "\x00\t<s></s><0x0A><unk>"]
    odd += ["".join(random.choice("ab the\n ▁éöin gtion,.12  🎉") for _ in range(random.randint(1, 120))) for _ in range(150)]
    texts = ["", *odd, *documents.values()]
    encoder, found = pieces.Encoder(pieces.load()), []
    for _, _, sizes, ids in encoder.encode(texts):
        ends = np.cumsum(sizes)
        found += [ids[e - s : e].tolist() for e, s in zip(ends, sizes, strict=True)]
    assert found == library.encode(texts)
    spelled = encoder.vocabulary.spelled
    assert [pieces.spell(i, spelled) for i in found] == [t.replace("▁", " ") for t in texts]


def test_pieces_query_and_decoding(spark, documents):
    found = LLM_QUERIES["op8_pieces"](spark, DATA)
    again = found.select("doc_id", "restored", "n_tokens", F.size("ids").alias("n"), pieces.decoded(spark, F.col("ids")).alias("text"))
    rows = again.collect()
    assert {r.doc_id: r.text for r in rows} == documents
    assert all(r.restored and r.n_tokens == r.n for r in rows)


def test_pseudonyms(documents):
    there, back = pseudonym.Permutation(b"key"), pseudonym.Permutation(b"key", undo=True)
    values = {
        "card": ["4111 1111 1111 1111", "4111-1111-1111-1111", "9807915762804490"],
        "iban": ["DE89370400440532013000", "GB82WEST12345698765432"],
        "date": ["1984-02-29", "12/31/1999", "31.12.1999", "2001/01/05", "31-12-1999"],
        "ssn": ["123-45-6789", "665-01-0001", "667-99-9999"],
        "phone": ["+1 (017) 555-7713", "+49 30 1234567"],
        "ip": ["64.147.79.24", "255.255.255.255"],
        "email": ["thinbleing.27@mail6.example.com", "A.b@x.org"],
        "secret": ["b44e15e09fd311c3cf3163b66d5a9875b883d8ce"],
    }
    for kind, texts in values.items():
        for value in texts:
            text, spans = pseudonym.replaced(f"before {value} after, {value}", there)
            if kind == "card" and pseudonym.check_digit(re.sub(r"\D", "", value)[:-1]) != value[-1]:
                continue
            assert [s["kind"] for s in spans] == [kind, kind]
            fresh = {text[s["start"] : s["start"] + s["length"]] for s in spans}
            assert len(fresh) == 1 and value not in text
            assert re.sub(r"[0-9a-zA-Z]", "x", fresh.pop()).count("x") >= 4 or kind == "ip"
            assert pseudonym.replaced(text, back)[0] == f"before {value} after, {value}"
    same = {re.sub(r"\D", "", pseudonym.replaced(v, there)[0]) for v in values["card"][:2]}
    assert len(same) == 1
    for stays in ("1234567890123456", "1999-02-30", "300.1.1.1", "000-12-3456", "v1.2.3", "no values"):
        assert pseudonym.replaced(stays, there) == (stays, [])
    for text in documents.values():
        assert pseudonym.replaced(pseudonym.replaced(text, there)[0], back)[0] == text
    assert sorted(there("x", i, 997) for i in range(997)) == list(range(997))
    assert [back("x", there("x", i, 997), 997) for i in range(997)] == list(range(997))


def test_word_hashes():
    texts = [b"", b"One two  one\tTWO\n", "Él él".encode(), b"x" * 50, b"   "]
    plain, bounds = tokens.WordHasher()(texts)
    assert np.diff(bounds).tolist() == [0, 4, 2, 1, 0]
    assert plain[0] == plain[2] and plain[1] == plain[3] and plain[4] != plain[5]
    latin, _ = tokens.WordHasher(latin=True)(texts)
    assert latin[4] == latin[5]
    long = [b"a b c " * 2_000_000]
    whole, cut = tokens.WordHasher()._hashed(long), tokens.WordHasher()(long)
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


@pytest.mark.parametrize("name, label, least", [("op5_ftrl", "quality", 0.95), ("op10_toxicity", "toxic", 0.92)])
def test_held_out_accuracy(spark, name, label, least):
    folder = "/root/testdata/sf0.01"
    marks = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", label)
    rows = LLM_QUERIES[name](spark, folder).join(marks, "doc_id").where("held_out").collect()
    assert all(0 <= r.score <= 1 for r in rows)
    assert sum(r.predicted == r[label] for r in rows) >= least * len(rows) > 20


def test_held_out_language(spark):
    truth = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    rows = LLM_QUERIES["op7_families"](spark, DATA).join(truth, "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.95 * len(rows) > 20


def test_ftrl_is_a_sparse_dot_product(spark, documents):
    docs = spark.createDataFrame(list(documents.items())[:20], "doc_id long, text string")
    weights = np.random.default_rng(1).standard_normal(ftrl.BUCKETS + 1).astype(np.float32)
    found = {r.doc_id: r.score for r in ftrl.add_score(docs, weights).collect()}
    for i, text in list(documents.items())[:20]:
        at, value = next(ftrl.sparse(iter([[text.encode()]]), tokens.WordHasher()))
        assert found[i] == pytest.approx(1 / (1 + np.exp(-(weights[at] @ value + weights[-1]))), abs=1e-4)


def test_votes_of_pairs():
    choice = families.Choice(["a", "b", "c"], [(0, 1), (0, 2), (1, 2)])
    best, chance = choice.votes(np.array([[1.0, 1.0, -1.0], [-1.0, 0.5, 2.0], [0.0, 0.0, 0.0]]))
    assert best[:2].tolist() == [0, 1] and chance[0] > 0.8 and (0 <= chance).all() and (chance <= 1).all()


def test_pipeline_is_its_stages(spark):
    """run() against the stages' own definitions on what each one gets."""
    import corpus_pipeline as pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    for name, stage in pipeline.STAGES:
        found = stage(spark, docs, DATA)
        before = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
        after = {r.doc_id: r for r in found.collect()}
        if name == "line_dedup":
            assert set(after) == set(before)
            assert all(set(after[i].text.split("\n")) <= set(t.split("\n")) for i, t in before.items())
        elif name == "near_dedup":
            roots = plain_components({i: plain_fingerprint(t) for i, t in before.items()})
            left = {i: before[i] for i in set(roots.values())}
            copied = plain_roots({i: t for i, t in left.items() if (t or "").split()})
            assert set(after) == {i for i in left if copied.get(i, i) == i}
        elif name == "decontamination":
            held = {r.doc_id for r in latent.contaminated(docs, spark.read.parquet(f"{DATA}/benchmark.parquet")).collect()}
            assert set(after) == set(before) - held and held
        elif name == "sentencepiece":
            assert set(after) == set(before) and all(r.restored for r in after.values())
        docs = found
    rows = {r.doc_id: r.ids for r in pipeline.run(spark, DATA).collect()}
    assert rows == {i: r.ids for i, r in after.items()}


@pytest.mark.parametrize("name", sorted(LLM_ORACLE))
def test_query_against_sql(spark, name):
    database = duckdb.connect()
    database.sql(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    df = LLM_QUERIES[name](spark, DATA)
    relation = database.sql(LLM_ORACLE[name])
    assert sorted(relation.columns) == sorted(df.columns)
    expected = sorted(tuple(r) for r in relation.select(", ".join(df.columns)).fetchall())
    assert sorted(tuple(r) for r in df.collect()) == expected


def test_line_dedup_stays_in_the_engine(spark):
    plan = LLM_QUERIES["op9_line_spread"](spark, DATA)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_registered():
    import __spark_entry__ as driver

    queries = driver.queries()
    for number in range(1, 14):
        assert sum(name.startswith(f"op{number}_") for name in queries) == 1
    assert "pipeline" in queries and set(LLM_ORACLE) <= set(driver.oracle_sql())
