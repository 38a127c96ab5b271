"""Token counts, periodic runs and tokenizer alignment against brute force."""

import hashlib
import re
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from fractions import Fraction
from functools import cache
from itertools import accumulate

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, row string, tokens array<int>, h0 string, special int, pair int"

ODD = [
    "it's we'll 's ''s don't'S x'reab 're\n've a'",
    "  two  spaces\n\n \tand tabs wide　white   end  ",
    "<|endoftext|>a <|endoftext|> <|endoftext|<|endoftext|>",
    "日本語テキスト 12³½ ⅷ éÀß́ \U0001f600\U0001f601 x​y ᲉꟋ",
    "▁x <0x41> <s></s> <unk> \x00 \x01\x7f \x85",
    " lead",
    "\n",
    " ",
    "'",
    "a\r\nb",
]


def texts():
    long = " ".join(f"word{k % 97},{k}" for k in range(4000))
    one = "x" * 9000 + "é" * 3000
    made = [*ODD, "", None, long, one, "to be or not to be " * 30, long, "a b " * 3, "same text"]
    return list(enumerate([*made, "same text", ODD[0]], start=100))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "r", [1], "h", 1, 2) for i, t in texts()]
    rows += [(None, "no id no id", None, None, None, None, None), (103, "again", "r", [], "", 0, 0)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def all_texts():
    return [*texts(), (None, "no id no id"), (103, "again")]


def by_value(rows):
    return sorted(map(tuple, rows), key=repr)


# Token counts


@cache
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(BYTES)


def token_count_rows(limit):
    coder = library()
    rows = []
    for i, t in all_texts():
        n = len(coder.encode(t or "", add_special_tokens=False).ids)
        rows.append((i, len((t or "").encode()), n, n > limit))
    return by_value(rows)


@pytest.mark.parametrize("head, chunk", [(1 << 19, 1 << 22), (5, 700), (0, 50)])
def test_token_counts(docs, empty, head, chunk):
    from corpusgraph.llm.token_counts import count_tokens

    found = count_tokens(docs, BYTES, limit=30, head=head, chunk_bytes=chunk)
    assert found.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    assert by_value(found.collect()) == token_count_rows(30)
    assert count_tokens(empty, BYTES, head=head).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab'sTrevl1½ \n\t 　.,é日́", max_size=25), max_size=4))
def test_pretokens_are_those_of_the_library(made):
    import numpy as np
    import pyarrow as pa

    from corpusgraph.llm.token_counts import character_kinds, pretokens
    from corpusgraph.llm.words import text_bytes

    data, bounds = text_bytes(pa.array(made, pa.string()))
    words = pretokens(data, bounds, character_kinds(BYTES))
    raw, splitter = data.tobytes(), library().pre_tokenizer
    for k, text in enumerate(made):
        here = range(words.first[k], words.first[k + 1])
        got = [raw[words.start[j] : words.start[j] + words.length[j]].decode() for j in here]
        assert got == [text[a:b] for _, (a, b) in splitter.pre_tokenize_str(text)]
    assert np.all(words.length > 0)


def test_kinds_of_characters_are_those_of_the_library():
    from corpusgraph.llm.token_counts import LETTER, NUMBER, WHITE, character_kinds

    kinds, splitter = character_kinds(BYTES), library().pre_tokenizer
    codes = [*range(0x3000), *range(0xA000, 0xD800, 3), *range(0xE000, 0x20000, 5)]
    for kind, lead in ((LETTER, "a"), (NUMBER, "1")):
        spans = splitter.pre_tokenize_str("".join(f"{lead}{chr(c)}\n" for c in codes))
        joined = {codes[a // 3] for _, (a, b) in spans if b - a == 2 and a % 3 == 0}
        assert joined == {c for c in codes if kinds[c] == kind}
    assert {c for c in codes if kinds[c] == WHITE} == {
        c for c in codes if chr(c).isspace() and not 0x1C <= c <= 0x1F
    }


def test_other_tokenizers_are_refused(docs):
    from corpusgraph.llm.token_counts import count_tokens

    with pytest.raises(ValueError, match="byte-level"):
        count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))


# Periodic runs


def brute_runs(words, least=6, times=4):
    found = set()
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= 2 * q and length >= max(least, times * q):
                part = words[i : i + length]
                if not any(part[r:] == part[:-r] for r in range(1, q)):
                    found.add((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


@settings(max_examples=150, deadline=None)
@given(
    st.lists(
        st.tuples(st.lists(st.integers(0, 2), max_size=9), st.integers(1, 9), st.lists(st.integers(0, 2), max_size=6)),
        max_size=5,
    ),
    st.sampled_from([(6, 4), (2, 2), (4, 3)]),
)
def test_runs_of_sequences(made, bounds):
    import numpy as np

    from corpusgraph.llm.periodic_runs import runs_of

    made = [unit * n + rest for unit, n, rest in made]
    found = runs_of([np.array(t, dtype=np.int64) for t in made], 3, *bounds)
    rows = defaultdict(list)
    for text, *run in zip(*(c.tolist() for c in found), strict=True):
        rows[text].append(tuple(run))
    for k, text in enumerate(made):
        assert rows[k] == brute_runs(text, *bounds)


@pytest.mark.parametrize("tree_words", [1 << 14, 10])
def test_periodic_runs(docs, empty, tree_words):
    from corpusgraph.llm.periodic_runs import periodic_runs

    found = periodic_runs(docs, tree_words=tree_words)
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in found.collect()]
    expected = []
    for i, t in all_texts():
        words = WORD.findall(t or "")
        if len(words) > 1000:  # no word of the long text comes back before 97 others
            assert len(set(words)) == len(words)
            runs = []
        else:
            runs = brute_runs(words)
        expected.append((i, len(words), runs, collapsed(words, runs)))
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert periodic_runs(empty).count() == 0


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_op12_query(spark):
    from corpusgraph.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = {tuple(r) for r in QUERIES["op12_periodic_runs"](spark, sf).collect()}
    expected = set()
    for row in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect():
        words = planted(row.doc_id, WORD.findall(row.text or ""))
        # Only some texts are short enough for the slow version; the others follow a run
        # that is checked in the same way, by all periods up to the planted one.
        runs = brute_runs(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
        numbers = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        digests = (sha(listed), sha(collapsed(words, runs)))
        expected.add((row.doc_id, len(runs), *numbers, *digests))
    assert got == expected


# Alignment


def spelled(model, ids):
    out = b""
    for k in ids:
        name = model.id_to_piece(k)
        out += bytes([int(name[3:-1], 16)]) if model.is_byte(k) else name.replace("▁", " ").encode()
    return out


def alignment_rows(items):
    import sentencepiece

    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(BYTES)
    coder.encode_special_tokens = True
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in plain}
    byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
    cuts, links, groups = {}, {}, {}
    for k, (_, text) in enumerate(items):
        a = coder.encode(" " + (text or ""), add_special_tokens=False).ids
        b = model.encode(text or "")
        a_bytes = [bytes(byte_of[c] for c in coder.id_to_token(x)) for x in a]
        b_bytes = [spelled(model, [x]) for x in b]
        whole = (" " + (text or "")).encode()
        if not text or b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            continue
        ends = [list(accumulate(map(len, x))) for x in (a_bytes, b_bytes)]
        cuts[k] = (a, b)
        links[k] = []
        for x, (end, size) in enumerate(zip(ends[0], map(len, a_bytes), strict=True)):
            j = bisect_right(ends[1], end - size)
            while j < len(b) and (ends[1][j - 1] if j else 0) < end:
                links[k].append((x, j))
                j += 1
        common = sorted(set(ends[0]) & set(ends[1]))
        parts, i, j = [], 0, 0
        for end in common:
            u, v = bisect_right(ends[0], end), bisect_right(ends[1], end)
            parts.append(",".join(map(str, a[i:u])) + ";" + ",".join(map(str, b[j:v])))
            i, j = u, v
        groups[k] = [p.replace(";", "|") for p in parts]
    counts = Counter((cuts[k][0][x], cuts[k][1][y]) for k in cuts for x, y in links[k])
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    rows = []
    for k, (doc_id, _) in enumerate(items):
        if k not in cuts:
            rows.append((doc_id, 0, 0, 0, 0, 0, 0, "", ""))
            continue
        a, b = cuts[k]
        pairs = [(a[x], b[y]) for x, y in links[k]]
        best = sum(counts[p] == most[p[1]] for p in pairs)
        text = ";".join(groups[k])
        numbers = (len(a), len(b), len(groups[k]), len(pairs), best, sum(counts[p] for p in pairs))
        rows.append((doc_id, *numbers, sha(text), text))
    return by_value(rows)


@pytest.mark.parametrize("head, piece", [(1 << 19, 256), (20, 3), (0, 1)])
def test_alignment(docs, empty, head, piece):
    from corpusgraph.llm.alignment import align

    found = align(docs, BYTES, PIECES, head=head, piece=piece, with_groups=True)
    got = by_value(found.collect())
    expected = alignment_rows(all_texts())
    assert got == expected
    assert sum(r[1] > 0 for r in got) > 8 and sum(r[1] == 0 for r in got) > 1
    assert align(empty, BYTES, PIECES, head=head).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.booleans(), st.booleans()), max_size=80), st.integers(1, 9))
def test_merge_of_ends(marks, size):
    import numpy as np

    from corpusgraph.llm.alignment import merge

    marks = [*marks, (True, True)]
    a, b = ([k + 1 for k, m in enumerate(marks) if m[side]] for side in (0, 1))
    made = merge(np.array(a), np.array(b), size)
    spans = [list(zip([0, *ends], ends)) for ends in (a, b)]
    pairs = [
        (i, j)
        for i, (s, e) in enumerate(spans[0])
        for j, (u, v) in enumerate(spans[1])
        if max(s, u) < min(e, v)
    ]
    assert sorted(zip(made.a.tolist(), made.b.tolist(), strict=True)) == pairs
    common = sorted(set(a) & set(b))
    assert made.a_group.tolist() == [sum(c < e for c in common) for e in a]
    assert made.b_group.tolist() == [sum(c < e for c in common) for e in b]


def test_queries_over_whole_tables(spark):
    from corpusgraph.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    coder = library()
    counts = QUERIES["op11_token_counts"](spark, sf).collect()
    made = {i: coder.encode(t or "", add_special_tokens=False).ids for i, t in items}
    assert by_value(counts) == by_value(
        (i, len((t or "").encode()), len(made[i]), len(made[i]) > 1024) for i, t in items
    )
    aligned = QUERIES["op13_tokenizer_alignment"](spark, sf)
    assert by_value(aligned.collect()) == by_value(r[:-1] for r in alignment_rows(items))


def _license_probes():
    from corpusgraph.llm import licenses as li

    conditions = li._REDISTRIBUTE.replace("met: ", "met:\n\n").replace(" 2. ", "\n\n2. ")
    bsd = f"Copyright (c) 2019, Some Body\nAll rights reserved.\n\n{conditions}\n\n{li._ENDORSE}\n\n{li._HOLDERS}"
    mit = f"MIT License\n\nCopyright (c) 2021 Jane\n\n{li._PERMIT}\n\n{li._PERMIT_NOTICE}\n\n{li._AS_IS}"
    comment = "\n".join(f"# {line}" for line in bsd.split("\n"))
    return [
        ("spdx", "// SPDX-License-Identifier: Apache-2.0\nint main;", "Apache-2.0"),
        ("tag", "SPDX-License-Identifier: MIT", "MIT"),
        ("id", "GPL-3.0-only", "GPL-3.0"),
        ("later", "LGPL-3.0-or-later", "LGPL-3.0"),
        ("short", "released under the GPLv3", "GPL-3.0"),
        ("cc", "available under CC BY 4.0", "CC-BY-4.0"),
        ("nc", "Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0"),
        ("d1/LICENSE", bsd, "BSD-3-Clause"),
        ("d1/e/f", None, "BSD-3-Clause"),
        ("d2/COPYING", mit, "MIT"),
        ("d2/f.LICENSE", "words of nothing", "MIT"),
        ("code.py", f"{comment}\nimport x", "BSD-3-Clause"),
        ("two", f"{li._REDISTRIBUTE} {li._HOLDERS}", "BSD-2-Clause"),
        ("reserved", "Copyright 2020 Foo. All rights reserved.", "Proprietary"),
        ("other", "Licensed under the Foo License, Version 2.0", None),
        ("zlib", "SPDX-License-Identifier: Zlib", None),
        ("german", "Mit.\nDen mit und.", None),
        ("prose", "the license of the public and the software is in the terms of use", None),
        ("long", "word " * 200_000 + "\nReleased under the MIT License.", "MIT"),
        ("long line", "Released under the MIT License. " + "word " * 200_000, None),
    ]


def test_licence_files_headers_and_ids(spark):
    from corpusgraph.llm.licenses import scan_licenses

    probes = _license_probes()
    files = spark.createDataFrame([p[:2] for p in probes], "path string, text string")
    got = {r.path: r.license for r in scan_licenses(files).collect()}
    assert got == {path: name for path, _, name in probes}


def test_licences_equal_cosines_over_all_units_and_templates(spark):
    """Every unit against every template, without the filter that finds headers first."""
    import math
    from collections import Counter

    from corpusgraph.llm import licenses as li
    from tests.conftest import SF

    texts = {path: text for path, text, _ in _license_probes() if text and "long" not in path}
    documents = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    texts |= {f"d/{r.doc_id}": r.text for r in documents.collect() if r.text}
    files = spark.createDataFrame(list(texts.items()), "path string, text string")
    got = {r.path: (r.license, r.similarity) for r in li.declared(files).collect()}

    held = li._held(li.TEMPLATES)
    least = 1 / len({name for name, _ in li.TEMPLATES})
    tallies = [Counter(li._words(text)) for _, text in li.TEMPLATES]

    def squares(counts, shared, seen):
        """Squared parts of a length: of shared terms with a share ``seen`` of headers, of the others with 1."""
        parts = [0.0, 0.0]
        for w, n in counts.items():
            logs = math.log(held.get(w, least)) + (math.log(seen) if w in shared else 0)
            parts[w not in shared] += ((1 + math.log(n)) * (1 - logs / 2)) ** 2
        return parts[0] / sum(parts)

    def could(counts, model):
        shared = counts.keys() & model.keys()
        if len(shared) < 2 or all(held[w] > min(held[v] for v in model) for w in shared):
            return False
        return squares(counts, shared, least) * squares(model, shared, least) >= li.THRESHOLD**2

    units, df = {}, Counter()
    for path, text in texts.items():
        name = path.split("/")[-1]
        mine = {(w, tuple(sorted(Counter(words).items()))) for w, words in li._units(text, name in ("LICENSE", "COPYING"))}
        for one in mine:
            if any(could(dict(one[1]), model) for model in tallies):
                units.setdefault(path, set()).add(one)
                df.update(w for w, _ in one[1])
    total = sum(map(len, units.values()))

    def idf(word):
        seen = max(df[word] / total, least)
        return 1 - (math.log(seen) + math.log(max(held.get(word, least), least))) / 2

    def vector(counts):
        raw = {w: (1 + math.log(n)) * idf(w) for w, n in counts}
        size = math.sqrt(sum(v * v for v in raw.values()))
        return {w: v / size for w, v in raw.items()}

    models = [(name, vector(Counter(li._words(text)).items())) for name, text in li.TEMPLATES]
    want = {}
    for path, text in texts.items():
        name = path.split("/")[-1]
        best = None
        for whole, words in li._units(text, name in ("LICENSE", "COPYING")):
            own = vector(Counter(words).items()) if words else {}
            for license_name, model in models:
                shared = own.keys() & model.keys()
                rare = min(held[w] for w in model)
                if len(shared) < 2 or all(held[w] > rare for w in shared):
                    continue
                cosine = round(sum(own[w] * model[w] for w in shared), 9)
                if cosine >= li.THRESHOLD:
                    one = (license_name != "Proprietary", whole, cosine, license_name)
                    best = max(best, one) if best else one
        if best:
            want[path] = best
    assert {p: one[0] for p, one in got.items()} == {p: one[3] for p, one in want.items()}
    assert all(abs(got[p][1] - one[2]) < 1e-8 for p, one in want.items())
    assert sum(p.startswith("d/") for p in want) > 3


@pytest.mark.parametrize("name", ["op4_decontamination", "op9_substring_dedup", "op10_warc"])
def test_sql_gives_the_rows_of_the_query(spark, name):
    import duckdb

    from corpusgraph.llm.queries import QUERIES, SQL
    from tests.conftest import SF

    base = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        base.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = QUERIES[name](spark, SF)
    want = base.execute(SQL[name])
    assert found.columns == [column[0] for column in want.description]
    assert Counter(map(tuple, found.collect())) == Counter(want.fetchall())
