"""Source mixing, source divergence and tokenizer alignment against brute force."""

import hashlib
import random
from collections import Counter, defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from siftgate.llm import source_audit, source_mix, token_alignment
from siftgate.llm.queries import SQL

SCHEMA = "doc_id int, text string, lang string, source string, size string, value long, row long, item string, _seed int"


def texts():
    rng = random.Random(11)
    vocab = ["".join(rng.choice("abcdeéöABC") for _ in range(rng.randint(1, 6))) for _ in range(120)]
    out = [(" ".join(rng.choice(vocab) for _ in range(rng.randint(1, 300))), rng.choice(["en", "de", "", None]),
            rng.choice(["s0", "s0", "s0", "s1", "s10", "s2", "é", None, ""])) for _ in range(150)]
    out += [out[3]] * 4
    out += [(None, "en", "s9"), ("", "fr", "s0"), ("", "fr", "s1"), ("  \n\t ", "de", "empty"), ("x" * 5000, "en", "s1"), ("1 2 3", "xx", "alone"),
            ("Zwei\x00wörter 🙂 ﬁ ﾊﾝ½ don't  we'll\n\n  <|endoftext|> <s> </s> <0x41> ▁ a\tb 　 c d 12345", "en", "s2"),
            (" ".join(rng.choice(vocab) for _ in range(20000)), "en", "s0")]
    return out


@pytest.fixture(scope="module")
def rows():
    return [(i if i % 9 else 0, *t) for i, t in enumerate(texts())]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, None, 3) for r in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def in_sql(rows, name):
    """Rows of a query's SQL over these documents."""
    con = duckdb.connect()
    doc_id, text, lang, source = zip(*rows)
    documents = pa.table({"doc_id": pa.array(doc_id, pa.int64()), "text": list(text), "lang": list(lang), "source": list(source)})
    con.register("documents", documents)
    cur = con.execute(SQL[name])
    return [c[0] for c in cur.description], cur.fetchall()


@pytest.mark.parametrize("seats", [0, 1, 2, 7, 100, 1001])
def test_highest_quotients(spark, seats):
    votes = {g: {k: (k * 37 + g * 11) % 23 for k in range(9)} for g in range(3)} | {3: {0: 0, 1: 0}, 4: {0: 5}}
    df = spark.createDataFrame([(g, k, v) for g, of in votes.items() for k, v in of.items()], "g int, k int, v long")
    got = {(r["g"], r["k"]): r["quota"] for r in source_mix.sainte_lague(df, "g", "k", F.col("v"), F.lit(seats)).collect()}
    for g, of in votes.items():
        held = dict.fromkeys(of, 0)
        for _ in range(seats if sum(of.values()) else 0):
            held[max(of, key=lambda k: (Fraction(of[k], 2 * held[k] + 1), -k))] += 1
        assert {k: got[g, k] for k in of} == held


def test_targets_reshare_what_full_sources_leave(spark):
    rng = random.Random(2)
    for n in (1, 2, 8, 30):
        sizes = {f"s{i:02d}": rng.choice([0, 1, 50, 1000, 20000]) for i in range(n)}
        weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sizes)}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        at = F.create_map(*[x for s, w in weights.items() for x in (F.lit(s), F.lit(w))])
        got = {r["source"]: r["target"] for r in source_mix.targets(df, at[F.col("source")]).collect()}
        left, target = Fraction(3 * sum(sizes.values()), 2), dict.fromkeys(sizes, Fraction(0))
        while left > 0:
            able = [s for s in sizes if target[s] < 2 * sizes[s]]
            each = left / sum(weights[s] for s in able)
            grown = {s: min(Fraction(2 * sizes[s]), target[s] + each * weights[s]) for s in able}
            left -= sum(grown[s] - target[s] for s in able)
            target |= grown
        assert got == pytest.approx({s: float(t) for s, t in target.items()}, rel=1e-12)


def test_mix(docs, rows):
    out = source_mix.mix(docs).collect()
    assert Counter((r["doc_id"], r["size"]) for r in out) == Counter((i, len((t or "").encode().split())) for i, t, _, _ in rows)
    taken, target, size = Counter(), {}, Counter()
    for r in out:
        assert r["taken"] <= 2 * r["size"] and r["taken"] == r["passes"] * r["size"] + sum(p["end"] - p["start"] for p in r["pieces"])
        ends = [x for p in r["pieces"] for x in (p["start"], p["end"])]
        assert ends == sorted(ends) and all(0 <= x <= r["size"] for x in ends)
        taken[r["source"]] += r["taken"]
        size[r["source"]] += r["size"]
        target[r["source"]] = r["target"]
    assert sum(target.values()) == pytest.approx(1.5 * sum(size.values()))
    for s, t in target.items():
        assert abs(taken[s] - t) <= max(0.005 * t, 1), s
    assert sorted(map(str, out)) == sorted(map(str, source_mix.mix(docs.repartition(7)).collect()))
    names, sql = in_sql(rows, "op11_source_mix")
    plain = lambda r, names: tuple(f"{r[n]:.9g}" for n in ("doc_id", "size", "source_size", "target", "taken"))
    assert sorted(plain(r, r.__fields__) for r in out) == sorted(plain(dict(zip(names, r)), names) for r in sql)


def test_mixed_parts(spark):
    df = spark.createDataFrame([("a b\nc d e", 2, [(1, 3), (4, 5)]), ("a", 0, [])], "text string, passes long, pieces array<struct<start:long,end:long>>")
    got = [r[0] for r in df.select(source_mix.mixed_parts(F.col("text"), F.col("passes"), F.col("pieces"))).collect()]
    assert got == [["a b\nc d e", "a b\nc d e", "b c", "e"], []]


def brute_divergence(rows):
    f = lambda p, q: (p - q) * (p - q) // q
    held, docs, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups[lang].add(source)
        terms = [t.decode() for t in source_audit.TERM.findall((text or "").encode().lower())]
        held[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= 3)
        share = lambda c: {t: 1 + 10**9 * (c[t] + 1) // (sum(c[x] for x in kept) + len(kept)) for t in kept}
        p = {s: share(held[lang, s]) for s in sources}
        q = share(sum((held[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if held[lang, s][t] and p[s][t] > q[t]]
            for part, values, top in (("pair", pairs, None), ("term", terms, 200)):
                ordered = sorted(values, key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, v, k) for k, (i, v) in enumerate(ordered[:top], 1)}
    return out


def test_divergence(docs, rows):
    out = source_audit.divergence(docs)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    got = [tuple(r) for r in out.collect()]
    want = brute_divergence(rows)
    assert len(got) == len(want) and set(got) == want
    assert any(r[2] == "pair" and r[4] == 0 and r[0] == "fr" for r in got) and not any(r[0] == "xx" for r in got)
    names, sql = in_sql(rows, "op12_source_audit")
    assert {tuple(r[names.index(c)] for c in out.columns) for r in sql} == want


def test_index_blocks_add_up(monkeypatch):
    """Small blocks, short reaches and batches that cut terms give the sums of one block."""
    rng = np.random.default_rng(3)
    lists = [np.sort(rng.choice(6, rng.integers(1, 7), replace=False)) for _ in range(200)]
    no = np.concatenate(lists)
    first = np.concatenate([[True] + [False] * (len(x) - 1) for x in lists])
    zero, p = np.array([5, 9, 2, 7, 3, 8])[no], rng.integers(10, 10**6, len(no))

    def total(batches):
        sums = Counter()
        for b in source_audit.shared_terms(batches):
            for a, o, v in zip(*(b[c].to_pylist() for c in ("a", "b", "value"))):
                sums[a, o] += v
        return sums

    batch = lambda i, j: pa.RecordBatch.from_arrays([pa.array(x[i:j]) for x in (no, p, zero, first)], ["no", "p", "zero", "first"])
    whole = total([batch(0, len(no))])
    want = Counter()
    f = lambda x, y: (x - y) * (x - y) // y
    at = 0
    for x in lists:
        for i in range(at, at + len(x)):
            for j in range(at, at + len(x)):
                if i != j:
                    a, b, c, d = (int(v) for v in (p[i], p[j], zero[i], zero[j]))
                    want[int(no[i]), int(no[j])] += f(a, b) - f(a, d) - f(c, b) + f(c, d)
        at += len(x)
    assert whole == want
    monkeypatch.setattr(source_audit, "POSTINGS", 40)
    monkeypatch.setattr(source_audit, "REACH", 11)
    assert total([batch(i, i + 17) for i in range(0, len(no), 17)]) == want


def test_slices_keep_terms(monkeypatch):
    text = ("alpha béta  gamma1delta " * 50).encode()
    want = source_audit.TERM.findall(text)
    monkeypatch.setattr(source_audit, "SLICE", 7)
    assert [t for part in source_audit.slices(text) for t in source_audit.TERM.findall(part)] == want


@pytest.fixture(scope="module")
def files():
    import public_tokenizers
    return token_alignment.read_files(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def brute_alignment(rows, files):
    tools = token_alignment.Tokenizers(files)
    out, count = [], Counter()
    for i, text, *_ in rows:
        groups, n = [], (0, 0)
        if text:
            a, b = tools.a.encode(" " + text, add_special_tokens=False).ids, tools.b.encode(text)
            raw = (" " + text).encode()
            if b"".join(tools.a_bytes[x] for x in a) == raw == b"".join(tools.b_bytes[x] for x in b):
                n = len(a), len(b)
                ends = [np.cumsum([len(t[x]) for x in ids]).tolist() for t, ids in ((tools.a_bytes, a), (tools.b_bytes, b))]
                at = [0, 0]
                for end in sorted(set(ends[0]) & set(ends[1])):
                    to = [e.index(end) + 1 for e in ends]
                    groups.append((a[at[0]:to[0]], b[at[1]:to[1]]))
                    at = to
        count.update((x[-1], y[-1]) for x, y in groups)
        out.append((i, *n, groups))
    best = Counter()
    for (_, y), c in count.items():
        best[y] = max(best[y], c)
    for i, n_a, n_b, groups in out:
        links = [(x[-1], y[-1]) for x, y in groups]
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        yield (i, n_a, n_b, len(groups), len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
               hashlib.sha256(text.encode()).hexdigest() if groups else "", text)


def test_alignment(docs, rows, files):
    out = token_alignment.align(docs, files, groups=True)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "groups"]
    want = list(brute_alignment(rows, files))
    assert sorted(tuple(r) for r in out.collect()) == sorted(want)
    assert any(w[1] and "," in w[-1] for w in want) and any(not w[1] for w in want)


def test_merging_by_ids_is_the_tokenizer(files):
    """The faster way gives the ids of the tokenizer itself, with white space, controls and broken characters of all kinds."""
    assert files.ranked
    tools, rng = token_alignment.Tokenizers(files), random.Random(4)
    parts = [" ", " ", "  ", "\n", "\t", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u200b", "\u3000", "a", "Word", "don't", "'s", "12", "é", "日本", "🙂",
             "\ufffd", "<|endoftext|>", ".,", "aaaa", "ﬁ", "e\u0301", "\U0001e030"]
    lines = ["".join(rng.choice(parts) for _ in range(40)) for _ in range(1500)] + ["".join(map(chr, rng.choices(range(1, 0xd800), k=60))) for _ in range(500)]
    lines += ["".join(rng.choices("abcdeht", k=rng.randint(1, 40))) for _ in range(3000)] + ["a" * 500, "ab" * 300, " " * 300]
    slow = tools.encode_a(lines)
    tools.fast_a = None
    assert tools.encode_a(lines) == slow


def test_other_merges_are_left_to_the_tokenizer(files):
    import json
    a = json.loads(files.a)
    assert not token_alignment.by_ranks({**a, "model": {**a["model"], "merges": a["model"]["merges"][::-1]}})
    assert not token_alignment.by_ranks({**a, "normalizer": {"type": "NFC"}})
    assert not token_alignment.by_ranks({**a, "pre_tokenizer": {**a["pre_tokenizer"], "add_prefix_space": True}})


def test_nothing(nothing, files):
    for out in (source_mix.mix(nothing), source_audit.divergence(nothing), token_alignment.align(nothing, files)):
        assert out.collect() == []


def test_only_nulls(spark, files):
    df = spark.createDataFrame([(None, None, None, None)] * 3, "doc_id long, text string, lang string, source string")
    assert [(r["size"], r["taken"], r["target"]) for r in source_mix.mix(df).collect()] == [(0, 0, 0.0)] * 3
    assert source_audit.divergence(df).collect() == []
    assert [tuple(r) for r in token_alignment.align(df, files).collect()] == [(None, 0, 0, 0, 0, 0, 0, "")] * 3
