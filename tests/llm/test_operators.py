"""The operators for training text against brute force, with nulls, ties and repeats."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hashes string, bucket int"


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def texts():
    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)] + ["É", "the", "The,"]
    line = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = line(20)
    block = "\n".join(line(4) for _ in range(12))
    made = [line(rng.randint(1, 80)) for _ in range(30)]
    made += [line(30) + " " + passage + "  \t" + line(30) for _ in range(4)]
    made += [line(9) + "\n" + block + "\n" + line(9) for _ in range(4)]
    made += [made[5], made[5], made[33] + " x", "", " \n ", None, None, "a b", line(3000), "same " * 40]
    return list(enumerate(made, start=10))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ["en", None][i % 2], "s", len(t or ""), "x", 1) for i, t in texts()]
    rows += [(None, "no id here", "en", None, 3, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_repeated_windows(docs, empty):
    from corpusgraph.llm.substrings import remove_repeated_windows

    found = remove_repeated_windows(docs, bucket_bytes=2000)
    assert set(docs.columns) <= set(found.columns)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_text, r.text) for r in found.collect()}
    first, words = {}, {i: WORD.findall(t or "") for i, t in texts()}
    for i, w in words.items():
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    for (i, w), (_, text) in zip(words.items(), texts(), strict=True):
        gone = {
            j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] < i for j in range(k, k + 13)
        }
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        assert got[i] == (len(w), len(gone), kept, text)
    assert got[None][1] == 0
    assert remove_repeated_windows(empty).count() == 0


def test_a_shared_window_does_not_fill_a_bucket():
    """Hits of one passage in 4,000 documents go to all buckets alike."""
    import pyarrow as pa

    from corpusgraph.llm.substrings import _answer, _send

    texts = [f"own{k} " + " ".join(f"w{j}" for j in range(13)) for k in range(4000)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4000)), pa.array(texts)], ["doc_id", "text"])
    sent = pa.Table.from_batches(_send(13, 64)(iter([batch])))
    load = Counter()
    for bucket, ids in zip(sent["bucket"].to_pylist(), sent["ids"].to_pylist(), strict=True):
        load[bucket] += len(ids) // 8
    assert len(load) == 64 and max(load.values()) < 4 * sum(load.values()) / 64
    # What the buckets answer are the hits of all documents but the first.
    answers = _answer(64)(iter(sent.sort_by("bucket").to_batches()))
    ids = b"".join(i for part in answers for i in part.column(2).to_pylist())
    assert sorted(np.frombuffer(ids, dtype=np.int64)) == list(range(1, 4000))


def fingerprint(text):
    words = WORD.findall(lowered(text))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 4]) for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, empty):
    from corpusgraph.llm.simhash import keep_one, near_duplicates

    got = {r.doc_id: (r.fingerprint, r.component_id) for r in near_duplicates(docs).collect()}
    prints = {i: fingerprint(t) for i, t in texts()}
    prints[None] = fingerprint("no id here")
    root = {i: i for i in prints}
    for a in prints:
        for b in prints:
            if (prints[a] ^ prints[b]).bit_count() <= 4 and root[a] != root[b]:
                old, new = root[a], root[b]
                root = {k: new if v == old else v for k, v in root.items()}
    for i, value in prints.items():
        group = [k for k in prints if root[k] == root[i] and k is not None]
        assert got[i] == (format(value, "016x"), min(group, default=None))
    kept = {r.doc_id for r in keep_one(docs).collect()}
    assert kept == {i for i in got if i is None or got[i][1] == i}
    assert near_duplicates(empty).count() == 0


def test_bit_planes_agree_with_popcount():
    from corpusgraph.llm.simhash import _marked, bit_planes, spanning_links, within_radius

    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (40, 5), dtype=np.uint64)
    prints = np.concatenate([base, base ^ flips[:, 0], base ^ np.bitwise_xor.reduce(flips, axis=1)])
    near = np.bitwise_count(prints[:, None] ^ prints[None, :])
    for radius in (0, 1, 3, 4, 5):
        marks = within_radius(bit_planes(prints), prints, radius)
        left, right = _marked(marks, len(prints))
        assert set(zip(left, right, strict=True)) == set(zip(*np.nonzero(near <= radius), strict=True))
    label = spanning_links(prints, 4)
    assert (label[40:80] == label[:40]).all()


def test_components_of_a_chain(spark):
    from corpusgraph.llm.components import components

    edges = [(k, k + 1) for k in range(100)] + [(500, 600), (600, 500), (7, 7), (None, 3)]
    found = components(spark.createDataFrame(edges, "u long, v long"))
    assert {tuple(r) for r in found.collect()} == {(k, 0) for k in range(101)} | {(500, 500), (600, 500)}


def test_line_chunks(spark, docs, empty):
    """Chunks cover all lines but those alone, and shift with the text."""
    from corpusgraph.llm.lines import chunks, line_hashes, remove_repeated_lines

    rng = random.Random(3)
    passage = [f"line {rng.random()}" for _ in range(40)]
    given = [(1, "\n".join(passage)), (2, "\n".join(["other", "lines", "first", *passage]))]
    given += [(3, "same\n" * 9 + "same"), (4, "\n\nx\n\ny\nz"), (5, "alone"), (6, "")]
    rows = spark.createDataFrame(given, "doc_id long, text string").selectExpr("doc_id", "0L tag", "text")
    found = defaultdict(dict)
    for r in chunks(line_hashes(rows)).collect():
        found[r.doc_id][r.place] = tuple(r.lines)
    assert min(len(c) for own in found.values() for c in own.values()) == 2
    for own in found.values():
        at = sorted(own)
        assert all(a + len(own[a]) <= b for a, b in zip(at, at[1:], strict=False))
    shared = [p for p, c in found[1].items() if found[2].get(p + 3) == c]
    assert len(shared) >= len(found[1]) - 2 and len(found[1]) >= 8
    assert set(found[3]) == {0} and len(found[3][0]) == 10 and set(found[4]) == {1} and not found[5]
    got = remove_repeated_lines(docs)
    assert set(got.columns) == {*docs.columns, "n_lines", "n_removed"} and got.count() == docs.count()
    assert remove_repeated_lines(empty).count() == 0


def without_windows(rows):
    """Text less repeated windows of two lines, by id; rows (id, text) in order of id."""
    seen, out = set(), {}
    for i, text in rows:
        units = re.split(r"\n(?=[\x20\x09\x0B-\x0D]*[^\x20\x09-\x0D])", text)
        gone = set()
        for k in range(len(units) - 1):
            window = units[k], units[k + 1].split("\n")[0]
            if WORD.search(units[k]) and window in seen:
                gone |= {k, k + 1}
            seen.add(window)
        out[i] = "\n".join(u for k, u in enumerate(units) if k not in gone)
    return out


def planted_passages():
    rng = random.Random(8)
    line = lambda n: " ".join(rng.choice("abcdefghij") * 3 + str(rng.randint(0, 9999)) for _ in range(n))
    rows, passages = [], {}
    for n in range(2, 13):
        passages[n] = [line(6) for _ in range(n)]
        for i in (100 + n, 300 + n, 200 + n):
            rows.append((i, "\n".join([line(6), line(6), *passages[n], line(6)])))
    rows += [(400, rows[5][1]), (401, "\n \n" + line(4) + "\n\n\n" + line(4)), (402, ""), (404, "one line")]
    rows += [(405, rows[-3][1] + "\n\nmore"), (406, "one line"), (407, "one line\n")]
    rows += [(408, "\n".join(passages[3] * 2)), (409, "p\nq\np\nq\np")]
    return sorted(rows), passages


def test_repeated_passages_of_two_lines_and_more(spark):
    from corpusgraph.llm.lines import remove_repeated_lines

    rows, passages = planted_passages()
    expected = without_windows(rows)
    docs = spark.createDataFrame([*rows, (None, rows[0][1]), (500, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in remove_repeated_lines(docs).collect()}
    assert len(got) == len(rows) + 2 and (got[500].text, got[500].n_lines, got[None].n_removed) == (None, 0, 0)
    for i, text in rows:
        assert got[i].text == expected[i]
        left = expected[i].count("\n") + 1 if expected[i] else 0
        assert (got[i].n_lines, got[i].n_removed) == (text.count("\n") + 1, text.count("\n") + 1 - left if text else 0)
    for n in passages:
        assert got[100 + n].n_removed == 0 and got[200 + n].n_removed == got[300 + n].n_removed == n
    assert got[400].text == "" and got[409].text == "p\nq"


def test_op2_query(spark):
    """The registered query against brute force, over a whole table."""
    from corpusgraph.llm.queries import op2_line_dedup
    from tests.conftest import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    left = without_windows(sorted((r.doc_id, r.text) for r in docs if r.text is not None))
    before = {r.doc_id: r.text for r in docs}
    got = op2_line_dedup(spark, SF).collect()
    assert len(got) == len(docs) and sum(r.n_removed for r in got) > 0
    for r in got:
        text = left.get(r.doc_id)
        assert r.kept_sha256 == (None if text is None else hashlib.sha256(text.encode()).hexdigest())
        assert r.n_lines == (0 if text is None else before[r.doc_id].count("\n") + 1)


def test_lines_that_share_a_hash(spark):
    from pyspark.sql import functions as F

    from corpusgraph.llm.lines import repeated_windows

    rows, _ = planted_passages()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tagged = docs.select("doc_id", F.xxhash64("text").alias("tag"), "text")
    found = lambda **more: {tuple(r) for r in repeated_windows(tagged, **more).collect()}
    weak = lambda c: F.pmod(F.xxhash64(c), F.lit(5))
    assert found(hashed=weak) == found() != set()


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))


def test_contamination(spark, docs, empty):
    from corpusgraph.llm.contamination import contamination, keep_clean

    given = dict(texts())
    some = [given[40], given[12][:40], "the", "", None, "É w1", given[40]]
    items = spark.createDataFrame(list(enumerate(some)), "item_id int, text string")
    got = {r.doc_id: r for r in contamination(docs, items).collect()}
    windows = defaultdict(set)
    for k, t in enumerate(some):
        w = plain(t)
        for s in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[s : s + 13])].add(str(k))
    for i, t in given.items():
        w, hit, found = plain(t), set(), set()
        for gram, names in windows.items():
            for s in range(len(w) - len(gram) + 1):
                if tuple(w[s : s + len(gram)]) == gram:
                    hit.update(range(s, s + len(gram)))
                    found |= names
        assert (got[i].n_words, got[i].n_hit, got[i].items) == (len(w), len(hit), sorted(found))
    clean = {r.doc_id for r in keep_clean(docs, items).collect()}
    assert {i for i in given if i not in clean} == {
        i for i in given if got[i].n_hit and 20 * got[i].n_hit >= got[i].n_words
    }
    assert contamination(empty, items).count() == 0
    assert contamination(docs, items.limit(0)).agg({"n_hit": "max"}).first()[0] == 0


def test_items_without_id_contaminate(spark):
    from corpusgraph.llm.contamination import contamination, keep_clean

    item = " ".join(f"n{k}" for k in range(15))
    docs = spark.createDataFrame([(1, f"a {item} b"), (2, "a b c"), (3, "short item")], "doc_id long, text string")
    items = spark.createDataFrame([(None, item), (None, "short item"), ("i", "short item")], "item_id string, text string")
    got = {r.doc_id: (r.n_hit, r.n_items, r["items"], len(r.spans or [])) for r in contamination(docs, items).collect()}
    assert got == {1: (15, 0, [], 3), 2: (0, 0, [], 0), 3: (2, 1, ["i"], 1)}
    assert {r.doc_id for r in keep_clean(docs, items).collect()} == {2}


def test_quality(docs, empty):
    from corpusgraph.llm.quality import judge, keep_good

    got = {r.doc_id: r for r in judge(docs, least_rows=5).collect()}
    for i, t in texts():
        w = WORD.findall(t or "")
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        count = Counter(zip(w, w[1:], w[2:], strict=False))
        again = {j for k in range(len(w) - 2) if count[tuple(w[k : k + 3])] > 1 for j in range(k, k + 3)}
        r = got[i]
        counts = (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
        symbols = sum(c in "#*$%&|<>" for c in t or "")
        assert counts == (len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(again))
        assert r.base_failed == (len(w) < 50 or 100 * len(again) > 50 * len(w))
        assert not (r.kept and r.base_failed)
    kept = {r.doc_id for r in keep_good(docs, least_rows=5).collect()}
    assert kept == {i for i in got if i is None or got[i].kept}
    assert judge(empty).count() == 0


def test_copies_do_not_pull_the_estimate(spark):
    from pyspark.sql import functions as F

    from corpusgraph.llm.quality import CUTOFF, robust_estimates, with_distance

    rng = np.random.default_rng(5)
    names = [f"x{i}" for i in range(6)]
    far, rows = [3000, 7000, 4500, 3500, 2000, 2500], []
    for group, copies in [("none", 0), ("fifth", 50), ("third", 100), ("more", 150)]:
        good = rng.normal([3000, 5200, 700, 1200, 200, 300], [400, 200, 500, 200, 150, 150], (200, 6))
        rows += [(group, False, *(int(v) for v in one)) for one in good]
        rows += [(group, True, *far)] * copies
    table = spark.createDataFrame(rows, f"group string, copy boolean, {', '.join(n + ' long' for n in names)}")
    found = with_distance(table, robust_estimates(table.select("group", *names)))
    got = {(r.group, r.copy): r for r in found.groupBy("group", "copy").agg(F.count("*").alias("n"), F.min("d2").alias("least"), F.max("d2").alias("most")).collect()}
    assert sum(r.n for r in got.values()) == len(rows)
    for (_, copy), r in got.items():
        assert r.least > CUTOFF if copy else r.most <= CUTOFF


def test_language_model(docs, empty):
    from corpusgraph.llm.language_model import score

    got = {r.doc_id: r for r in score(docs).collect()}
    tokens = {i: [*WORD.findall(t or ""), "\n"] for i, t in texts()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    count = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    total = sum(count.values())
    for i, t in tokens.items():
        base = sum(np.log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1))) for w in t)
        known = sum(count[w] > 0 for w in t)
        r = got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(t), known, total)
        assert r.base_score == pytest.approx(base) and r.score < 0
    assert got[None].held_out
    assert score(empty).count() == 0


def test_language_model_lower_case(spark):
    from corpusgraph.llm.language_model import score

    made = ["The cat", "the CAT THE", "É é cat", "THE É unSeen", "Unseen zebra-ZEBRA", None, "A\u00a0b a\u00a0B"] * 3
    rows = list(enumerate([*made, "never MET", "Never Met"], start=1))
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows}
    assert 0 < sum(held.values()) < len(rows)
    tokens = {i: [*WORD.findall(lowered(t)), "\n"] for i, t in rows}
    count = Counter(w for i, t in tokens.items() if not held[i] for w in t)
    total = sum(count.values())
    found = score(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    for r in found:
        t = tokens[r.doc_id]
        base = sum(np.log10((count[w] + 0.1) / (total + 0.1 * (len(count) + 1))) for w in t)
        known = sum(count[w] > 0 for w in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(t), known, total)
        assert r.base_score == pytest.approx(base)


def test_language_model_tells_words_of_a_class_apart(spark):
    from corpusgraph.llm.language_model import score

    # "xaar" and "ybar" end alike, so they are of one class, and come equally often.
    filler = [f"f{k}" for k in range(16)]
    rows = [("red", "xaar"), ("blue", "ybar")] * 150 + [("blue", "xaar"), ("red", "ybar")] * 3
    made = [(i, " ".join([*filler, *pair, *filler])) for i, pair in enumerate(rows, start=1) if zlib.crc32(str(i).encode()) % 10]
    held = [i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 10 == 0][:4]
    asked = [(x, y) for x in ("red", "blue") for y in ("xaar", "ybar")]
    made += [(i, " ".join([*filler, *pair, *filler])) for i, pair in zip(held, asked, strict=True)]
    found = score(spark.createDataFrame(made, "doc_id long, text string")).collect()
    got = {pair: next(r for r in found if r.doc_id == i) for i, pair in zip(held, asked)}
    assert all(r.held_out for r in got.values())
    assert got["red", "xaar"].score > got["red", "ybar"].score + 0.05
    assert got["blue", "ybar"].score > got["blue", "xaar"].score + 0.05


def test_language_model_trees():
    from corpusgraph.llm.language_model import SMOOTHING, Model, _inner_log, _learn_inner, _trees

    random = np.random.default_rng(2)
    counts = random.integers(1, 50, 40)
    classes = np.concatenate([[0, 1], random.integers(2, 5, 38)])
    others = np.array([7.0, 8.0, 0.1, 900.0, 12.3, 5.0])  # the last class has no frequent word
    trees = _trees(classes, counts, others, 2)
    words, none = np.arange(1, 41, dtype=np.uint64), np.zeros(0)
    cells = np.zeros(1 << 12, dtype=np.float32)
    model = Model(words, counts, words[:1], 0, 0, none, none, none, *trees, others, cells)
    before = tuple(np.full(46, m, dtype=np.uint32) for m in (3, 1 << 30, 77))
    leaves, of_class = np.arange(46), np.concatenate([classes, np.arange(6)])
    mass = np.concatenate([counts + SMOOTHING, others])
    flat = 10 ** _inner_log(model, leaves, before)
    for k in range(2, 6):
        mine = of_class == k
        assert flat[mine] == pytest.approx(mass[mine] / mass[mine].sum())
    model.cells = random.normal(size=len(cells)).astype(np.float32)
    for k in range(2, 6):
        assert (10 ** _inner_log(model, leaves, before))[of_class == k].sum() == pytest.approx(1)
    # One step is towards the words that were seen, by the sum of their slopes.
    seen = np.flatnonzero(of_class == 3)[[0, 0, 0, 1]]
    some = tuple(m[:4] for m in before)
    changed = model.cells.copy()
    _learn_inner(model, changed, np.full(len(cells), 1e-3, np.float32), seen, some)
    was = _inner_log(model, seen, some).sum()
    model.cells = changed
    assert _inner_log(model, seen, some).sum() > was


def test_language_model_sums_and_places():
    from corpusgraph.llm.language_model import _added, _places, _summed

    def in_pairs(values):
        while len(values) > 1:
            pairs = [values[i : i + 2] for i in range(0, len(values), 2)]
            values = [p[0] + p[1] if len(p) == 2 else p[0] for p in pairs]
        return values[0]

    random = np.random.default_rng(1)
    rows = np.concatenate([np.full(1000, 7), random.integers(1, 400, 500), random.integers(1, 1 << 14, 300)])
    rows = random.permutation(rows)
    values = random.normal(size=(len(rows), 3)).astype(np.float32)
    before = values.copy()
    found, sums = _summed(rows, values)
    assert found.tolist() == sorted(set(rows.tolist())) and (values == before).all()
    for row, got in zip(found, sums):
        assert got.tolist() == in_pairs(list(values[rows == row])).tolist()
    for size in (1, 2, 3, 7, 1000):
        assert _added(values[:size]).tolist() == [in_pairs(list(values[:size])).tolist()]

    for size in (0, 1, 5, 4000):
        words = np.unique(random.integers(0, 1 << 64, size, dtype=np.uint64) >> np.uint64(size % 2 * 40))
        asked = np.concatenate([words, words + np.uint64(1), random.integers(0, 1 << 64, 3000, dtype=np.uint64)])
        wanted = np.minimum(np.searchsorted(words, asked), max(0, len(words) - 1))
        assert _places(words, asked).tolist() == wanted.tolist()


def test_packing(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    from corpusgraph.llm.packing import hilbert_keys, pack

    path = public_tokenizers.path
    files = path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken")
    coder = Tokenizer.from_file(files[0])
    pieces = pack(docs, *files, size=64, range_tokens=3000).collect()
    parts, rooms = defaultdict(list), defaultdict(list)
    for r in pieces:
        parts[r.doc_id].append((r.start, r.length, bytes(r.ids), r.ids_crc32))
        rooms[r.sequence_id].append((r.offset, r.length))
    for i, t in texts():
        ids = np.array([*coder.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        assert b"".join(p[2] for p in sorted(parts[i])) == ids.tobytes()
        assert all(zlib.crc32(p[2]) == p[3] for p in parts[i])
    for places in rooms.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= 64 and end & (end - 1) == 0
    assert pack(empty, *files).count() == 0
    grid = np.stack(np.meshgrid(*[range(4)] * 3, indexing="ij"), axis=-1).reshape(-1, 3)
    walk = grid[np.argsort(hilbert_keys(grid, 2))]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_shards(spark, docs, empty, tmp_path):
    from corpusgraph.llm.shards import assign_shards, load_map, rebalance

    rows = assign_shards(docs, shards=4, map_path=str(tmp_path / "map")).collect()
    assert len(rows) == docs.count()
    places = defaultdict(list)
    for r in rows:
        places[r.shard].append(r.position)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    assert {r.doc_id: (r["size"], r.text_crc32) for r in rows if r.doc_id} == {
        i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in texts()
    }
    first = load_map(spark, str(tmp_path / "map"))
    grown = rebalance(first, first.size_of, shards=5)
    moved = [(a, b) for a, b in zip(first.shard_of, grown.shard_of, strict=True) if a != b]
    assert grown.version == 2 and moved and grown.sizes()[4] > 0
    assert assign_shards(empty).count() == 0


def test_shards_of_hot_and_missing_ids(spark):
    """A third of the rows without id, a third with one id: shards stay near equal."""
    from corpusgraph.llm.shards import assign_shards

    ids = [None] * 2000 + [7] * 2000 + list(range(1000, 3000))
    docs = spark.createDataFrame([(i, "x" * 60) for i in ids], "doc_id long, text string")
    rows = assign_shards(docs, shards=16).collect()
    sizes, places = Counter(), defaultdict(list)
    for r in rows:
        sizes[r.shard] += r["size"]
        places[r.shard].append(r.position)
    assert len(rows) == 6000 and max(sizes.values()) <= 1.02 * min(sizes.values())
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_op7_query(spark):
    """The query stores two versions of the map, and its rows are near equal in bytes."""
    from corpusgraph.llm.queries import op7_sharding
    from tests.conftest import SF

    rows = op7_sharding(spark, SF).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.shard] += r["size"]
    largest = max(r["size"] for r in rows)
    assert len(sizes) == 16 and max(sizes.values()) - min(sizes.values()) <= largest
    shard_of = {}
    assert all(shard_of.setdefault(r.virtual_slot, r.shard) == r.shard for r in rows)


def test_clashing_names(spark):
    """Stages keep columns that are named like their own."""
    from pyspark.sql import functions as F

    from corpusgraph.llm.contamination import keep_clean
    from corpusgraph.llm.quality import keep_good
    from corpusgraph.llm.simhash import keep_one
    from tests.conftest import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    docs = docs.withColumns({c: F.lit(1) for c in ("_gone_id", "__gone_id", "kept", "tag", "n_words")})
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    for kept in (keep_good(docs), keep_one(docs), keep_clean(docs, bench)):
        assert kept.columns == docs.columns and 0 < kept.count() <= 60


def test_warc_round_trip(spark, empty, tmp_path):
    from corpusgraph.llm.warc import read_archive, sha1_digest, write_archive

    rows = [(3, "http://a/ ü", "x" * 3000), (1, "http://b", "same"), (2, None, "same"), (2, None, "same")]
    rows += [(k, f"http://c/{k}", f"<p>{k}</p>" * 200 + "ç\r\n\r\n") for k in range(10, 40)]
    rows += [(50, "u", None), (51, "u", ""), (None, "n", "same")]
    pages = spark.createDataFrame([(*r, 7) for r in rows], "page_id long, url string, html string, key int")
    folder = str(tmp_path / "warc")
    manifest = write_archive(pages, folder, file_bytes=1500, range_bytes=8000)
    files = manifest.collect()
    assert len(files) > 3 and sum(f.records for f in files) == len(rows)
    for f in files:
        data = open(f.file.removeprefix("file://"), "rb").read()
        assert (len(data), hashlib.sha256(data).hexdigest()) == (f.bytes, f.sha256)
    got = read_archive(spark, folder).collect()
    payload = {r.page_id: bytes(r.payload) for r in got if r.record_type == "response"}
    assert payload[3] == b"x" * 3000 and payload[10] == rows[4][2].encode() and payload[1] == b"same"
    kinds = sorted((r.page_id or 0, r.record_type, r.refers_to or 0, r.url or "") for r in got)
    assert [k for k in kinds if k[0] in (1, 2, 50, 51)] == [
        (1, "response", 0, "http://b"),
        (2, "revisit", 1, ""),
        (2, "revisit", 1, ""),
        (50, "response", 0, "u"),
        (51, "revisit", 50, "u"),
    ]
    assert {r.payload_digest for r in got if r.page_id == 2} == {sha1_digest(b"same")}
    none = empty.selectExpr("doc_id page_id", "text url", "text html")
    assert write_archive(none, str(tmp_path / "none")).count() == 0
    assert read_archive(spark, str(tmp_path / "none")).count() == 0


def test_licenses(spark):
    from corpusgraph.llm.licenses import scan_licenses

    mit, gpl = "x\nReleased under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
    rows = [("a/LICENSE", mit), ("a/b/c/f", "words"), ("a/b/g", gpl), ("a/b/c/d/LICENSE.txt", gpl)]
    rows += [("a/b/c/d/e", None), ("z/f", ""), (None, mit), ("a/b/c/f", "words")]
    files = spark.createDataFrame([(*r, 1) for r in rows], "path string, text string, license int")
    got = Counter((r.path, r.license) for r in scan_licenses(files).collect())
    assert got == Counter(
        [("a/LICENSE", "MIT"), ("a/b/c/f", "MIT"), ("a/b/c/f", "MIT"), ("a/b/g", "GPL-3.0")]
        + [("a/b/c/d/LICENSE.txt", "GPL-3.0"), ("a/b/c/d/e", "GPL-3.0"), ("z/f", None), (None, None)]
    )
    assert scan_licenses(files.limit(0)).count() == 0


def test_a_header_declares_alike_on_tables_of_any_size(spark):
    from corpusgraph.llm.licenses import declared

    headers = ["All rights reserved.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0."]
    headers += ["Licensed under the Apache License, Version 2.0.", "Copyright-free words of some other licence"]
    found = []
    for times in (1, 100, 2000):
        rows = [(f"{k}/{n}", line) for k in range(times) for n, line in enumerate(headers)]
        got = declared(spark.createDataFrame(rows, "path string, text string")).collect()
        found.append({(r.path.split("/")[1], r.license, round(r.similarity, 9)) for r in got})
    assert ("0", "Proprietary") in {one[:2] for one in found[0]}
    assert found[0] == found[1] == found[2]


def test_pipeline_stages(spark):
    import corpus_pipeline
    from tests.conftest import SF

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES][-1] == "packing"
    pieces = corpus_pipeline.run(spark, SF).groupBy("doc_id").agg({"length": "sum"}).count()
    assert 0 < pieces < docs.count()
    for _, stage in corpus_pipeline.STAGES[1:2]:
        assert stage(spark, docs, SF).columns == docs.columns
