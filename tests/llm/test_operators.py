"""Every operator against brute force on a small table with copies, near copies, passages, nulls, ties and long texts."""

import base64
import itertools
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from siftgate.llm import (automaton_dedup, byte_bpe, decontaminate, edits, fuzzy_lines, line_rules, ngram_lm, pii_boost, quality_model,
                          set_join, spans, suffix_groups)
from siftgate.llm.queries import tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, start int, kept string"


def texts():
    rng = random.Random(5)
    vocab = ["".join(rng.choice("abcdeéö") for _ in range(rng.randint(2, 6))) for _ in range(400)]
    say = lambda n: [rng.choice(vocab) for _ in range(n)]
    join = lambda w: " ".join(w)
    one, passage, out = say(160), say(70), []
    for i in range(14):
        body = say(rng.randint(20, 160))
        if i % 3 == 0:
            body[10:10] = passage
        out.append(join(body[:40]) + ".\n" + join(body[40:]))
    out += [join(one), join(one)]
    for k in range(6):
        near = list(one)
        near[20 + 9 * k] = "edit" + str(k)
        out.append(join(near))
    out += [None, "", "  \n\t ", "Short one", "a b c d " * 60, join(passage), "x" * 3000, "THE!! END!! " * 30, "é ö\r\nüü  \tß",
            "mail a.b@c.de or a@b.c_d@e.f, 1.2.3.4 1.2.3.400 4111 1111 1111 1111 +49 (30) 123456-78 +1 2", "".join(map(chr, range(1, 400)))]
    out.append(join(say(4000)) + " " + join(passage))
    return out


@pytest.fixture(scope="module")
def rows():
    return list(enumerate(texts()))


@pytest.fixture(scope="module")
def docs(spark, rows):
    data = [(d, t, "en", None if d % 5 == 0 else f"s{d % 2}", len(t or ""), 1, "x") for d, t in rows]
    return spark.createDataFrame(data, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text):
    return (text or "").encode().split()


def by_id(df):
    got = {}
    for r in df.collect():
        assert r["doc_id"] not in got
        got[r["doc_id"]] = r
    return got


def removed(sequences, window, within):
    first, out = {}, {}
    for d, s in sequences:
        gone = [0] * len(s)
        for i in range(len(s) - window + 1):
            at = first.setdefault(bytes(s[i:i + window]) if isinstance(s, bytes) else tuple(s[i:i + window]), (d, i))
            if at[0] < d or within and at < (d, i):
                gone[i:i + window] = [1] * window
        out[d] = gone
    return out


def test_automaton_dedup(docs, rows, nothing, monkeypatch):
    want = removed([(d, words(t)) for d, t in rows], 50, False)
    assert sum(map(sum, want.values())) > 500
    for hot in (5_000, 2):  # the way for hot anchors gives the same
        monkeypatch.setattr(automaton_dedup.repeats, "HOT", hot)
        got = by_id(automaton_dedup.remove_passages(docs))
        for d, t in rows:
            left = b" ".join(w for w, g in zip(words(t), want[d]) if not g).decode()
            assert (got[d]["n_words"], got[d]["n_removed"], got[d]["kept_text"]) == (len(words(t)), sum(want[d]), left)
    assert automaton_dedup.remove_passages(nothing).count() == 0


def test_suffix_groups(docs, rows, nothing, monkeypatch):
    want = removed([(d, (t or "").encode()) for d, t in rows], 100, True)
    for hot in (5_000, 2):
        monkeypatch.setattr(suffix_groups.repeats, "HOT", hot)
        got = by_id(suffix_groups.remove_repeats(docs))
        for d, t in rows:
            body = (t or "").encode()
            spans = sum(g and not p for p, g in zip([0, *want[d]], want[d]))
            assert (got[d]["n_bytes"], got[d]["n_removed"], got[d]["n_spans"]) == (len(body), sum(want[d]), spans)
            assert bytes(got[d]["kept"]) == bytes(b for b, g in zip(body, want[d]) if not g)
    assert suffix_groups.remove_repeats(nothing).count() == 0


def test_suffix_array_is_sorted():
    rng = random.Random(1)
    for _ in range(400):
        text = [rng.randint(1, 3) for _ in range(rng.randint(0, 40))] + [0]
        assert suffix_groups.suffix_array(text) == sorted(range(len(text)), key=lambda i: text[i:])


def test_byte_bpe(docs, rows, nothing):
    tiktoken = pytest.importorskip("tiktoken")
    path, pattern = tokenizer()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    peer = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    got = by_id(byte_bpe.encode_decode(docs, path, pattern))
    for d, t in rows:
        ids = peer.encode_ordinary(t or "")
        assert bytes(got[d]["ids"]) == b"".join(i.to_bytes(4, "little") for i in ids)
        assert bytes(got[d]["decoded"]) == (t or "").encode()
    assert byte_bpe.encode_decode(nothing, path, pattern).count() == 0


def test_set_join(docs, rows, nothing):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for size, percent in ((4, 85), (5, 80)):
        sets = {}
        for d, t in rows:
            w = words((t or "").translate(low))
            sets[d] = {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()
        root = {d: d for d in sets}
        for _ in sets:
            for a, b in itertools.combinations(sets, 2):
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
        assert len(set(root.values())) < len(root)
        got = by_id(set_join.similar_sets(docs, size, percent))
        assert {d: (r["n_shingles"], r["component_id"]) for d, r in got.items()} == {d: (len(sets[d]), root[d]) for d in sets}
    assert set_join.similar_sets(nothing).count() == 0


def test_language_model(docs, rows, nothing, monkeypatch):
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {d: [*words((t or "").translate(low)), None] for d, t in rows}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tokens}
    one, two = Counter(), Counter()
    for d, w in tokens.items():
        if not held[d]:
            one.update(w)
            two.update(zip([0, *w[:-1]], w))
    total, kinds, firsts = sum(one.values()), len(one), sum(not h for h in held.values())
    for common in (400_000, 20):  # rare words by the join
        monkeypatch.setattr(ngram_lm, "COMMON", common)
        for d, r in by_id(ngram_lm.language_model(docs)).items():
            w = tokens[d]
            assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[d], len(w), sum(one[x] > 0 for x in w), total)
            assert r["base_score"] == pytest.approx(sum(math.log10((one[x] + 1) / (total + kinds + 1)) for x in w))
            if common > 20:
                want = sum(math.log10((two[u, v] + 4 * (one[v] + 1) / (total + kinds + 1)) / ((firsts if u == 0 else one[u]) + 4)) for u, v in zip([0, *w[:-1]], w))
                assert abs(r["score"] - want) <= len(w) * ngram_lm.STEP  # two quantised logarithms a token
            else:
                assert r["score"] < 0
    assert ngram_lm.language_model(nothing).count() == 0


def test_language_model_rare_words(docs, rows, monkeypatch):
    """A small table of common words does not change the score."""
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {d: [*words((t or "").translate(low)), None] for d, t in rows}
    one, two, firsts = Counter(), Counter(), 0
    for d, w in tokens.items():
        if zlib.crc32(str(d).encode()) % 7 != 2:
            one.update(w)
            two.update(zip([0, *w[:-1]], w))
            firsts += 1
    below = sum(one.values()) + len(one) + 1
    for common in (0, 20):
        monkeypatch.setattr(ngram_lm, "COMMON", common)
        for d, r in by_id(ngram_lm.language_model(docs)).items():
            w = tokens[d]
            want = sum(math.log10((two[u, v] + 4 * (one[v] + 1) / below) / ((firsts if u == 0 else one[u]) + 4)) for u, v in zip([0, *w[:-1]], w))
            assert abs(r["score"] - want) <= len(w) * ngram_lm.STEP


def test_decontamination(spark, nothing):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(3000)]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.randint(14, 50)))) for k in range(12)] + [(99, None), (98, "")]
    docs, want = [], set()
    for d in range(90):
        body = [rng.choice(vocab) for _ in range(rng.randint(60, 200))]
        if d % 3 == 0:
            k, text = items[d % 12]
            part = text.split()
            for _ in range(d % 2 * max(1, len(part) // 12)):
                part[rng.randrange(len(part))] = "edit"
            body[30:30] = part
            want.add((d, k))
        docs.append((d, " ".join(body).title() + "."))
    docs += [(200, None), (201, "")]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), table).collect()}
    assert got <= want and len(got) >= 0.9 * len(want)
    assert decontaminate.contaminated(nothing, table).count() == 0
    assert decontaminate.contaminated(nothing, table.limit(0)).count() == 0


def test_edit_distance():
    rng = random.Random(2)
    for _ in range(2000):
        a, b = ([rng.randint(0, 3) for _ in range(rng.randint(1, 8))] for _ in range(2))
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(last + (x != y), row[j - 1] + 1, row[j] + 1)
        for most in (0, 1, 3):
            assert decontaminate.edit_distance(a, b, most) == min(row[-1], most + 1)


def test_fuzzy_lines(spark, nothing):
    line = " ".join(f"word{i}" for i in range(200))
    near = line.replace("word150", "word15o")
    docs = spark.createDataFrame([(1, line + "\nown line\n\nlast"), (2, "first\n" + near + "\n  OWN line "), (3, line), (4, None), (5, ""), (6, "other\nother")],
                                 "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_lines"], r["n_removed"]) for r in fuzzy_lines.remove_fuzzy_lines(docs).collect()}
    assert got == {1: (line + "\nown line\n\nlast", 3, 0), 2: ("first", 3, 2), 3: ("", 1, 1), 4: (None, 0, 0), 5: ("", 0, 0), 6: ("other", 2, 1)}
    assert fuzzy_lines.remove_fuzzy_lines(nothing).count() == 0


def test_fuzzy_lines_recall(spark):
    """Near copies of any line length are found: one letter or word changed, and as many edits anywhere as similarity 0.8 allows."""
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    say = lambda n: " ".join("".join(rng.choice(letters) for _ in range(rng.randint(3, 8))) for _ in range(n))

    def letter(line):
        i = rng.randrange(len(line))
        return line[:i] + "#" + line[i + 1:]

    def word(line):
        w = line.split()
        i = rng.randrange(len(w))
        w[i] = "#" * len(w[i])
        return " ".join(w) if 5 * len(w[i]) <= len(line) else letter(line)

    def limit(line):
        out = list(line)
        for _ in range(len(line) // 5):
            i, kind = rng.randrange(len(out)), rng.random()
            out[i:i + (kind >= 0.3)] = [] if kind > 0.7 else rng.choice(letters)
        return "".join(out)

    def alike(a, b):
        n = max(len(a), len(b))
        return decontaminate.edit_distance(list(a), list(b), n // 5) <= n // 5

    rows, kinds = [], {}
    for n in (2, 5, 10, 20, 50):
        for change in (letter, word, limit):
            for _ in range(60):
                a = say(n)
                b = change(a)
                if a != b and b == b.strip() and alike(a, b):
                    rows += [(len(rows), a), (len(rows) + 1, b)]
                    kinds[len(rows) - 1] = n, change.__name__
    got = {r["doc_id"]: r["n_removed"] for r in fuzzy_lines.remove_fuzzy_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    recall = {k: [got[d] for d in kinds if kinds[d] == k] for k in set(kinds.values())}
    print({k: (sum(x), len(x)) for k, x in sorted(recall.items())})
    assert len(recall) == 15 and all(len(x) >= 20 and sum(x) >= (0.9 if k[1] == "limit" else 0.98) * len(x) for k, x in recall.items())
    short = [(d, t) for d, t in rows if len(t) < 60]
    for d, t in rows:  # removed lines have an earlier partner
        if got[d] and d not in kinds:
            assert any(alike(t, u) for e, u in (short if len(t) < 60 else rows) if e < d)


def test_personal_data(docs, rows, nothing):
    patterns = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    def valid(k, m):
        d = re.sub("[^0-9]", "", m)
        return k == 0 or k == 1 and all(int(x) <= 255 for x in m.split(".")) or k == 2 and 14 <= len(d) <= 19 and luhn(d) or k == 3 and 10 <= len(d) <= 15

    got, some = by_id(pii_boost.personal_data(docs)), 0
    for d, t in rows:
        want = sorted((m.start(), k, m.end()) for k, p in enumerate(patterns) for m in re.finditer(p, t or "") if valid(k, m.group()))
        some += len(want)
        assert [(s["start"], s["kind"], s["end"]) for s in got[d]["base"]] == want
    assert some >= 5 and pii_boost.personal_data(nothing).count() == 0


def test_personal_data_added(spark):
    """Loose forms beyond the base patterns are added, numbers that are no personal data are not."""
    rng = random.Random(4)
    number = lambda n: "".join(rng.choice("123456789") for _ in range(n))

    def card(good):
        while True:
            d = number(16)
            if good == (sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0):
                return d

    rows, want = [], {}
    for d in range(400):
        dotted = card(True)
        spans = [(0, f"joe{d} (at) host{d} (dot) com"), (2, ".".join(dotted[i:i + 4] for i in (0, 4, 8, 12))), (3, f"0{number(3)} {number(4)} {number(4)}")]
        text = "words of a text, write to {} or pay with card {} or call {} now".format(*(s for _, s in spans))
        want[d] = {(text.index(s), text.index(s) + len(s), k) for k, s in spans}
        rows.append((d, f"{text}; order {card(False)}, build {number(13)}, version 3.700.{number(3)}.1, meet (at) noon"))
    got = {r["doc_id"]: r for r in pii_boost.personal_data(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for d, _ in rows:
        assert {(s["start"], s["end"], s["kind"]) for s in got[d]["added"]} == want[d]


def test_line_rules(docs, rows, nothing):
    got = by_id(line_rules.line_frequency_rules(docs))
    for d, t in rows:
        w = words(t)
        seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
        again = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if words(x)]
        r = got[d]
        assert (r["n_words"], r["n_repeat_words"], r["n_dup_lines"]) == (len(w), len(again), len(lines) - len(set(lines)))
        assert (r["word_chars"], r["n_symbols"]) == (sum(len(x.decode()) for x in w), len(re.findall(r"[#*$%&|<>]", t or "")))
        assert r["base_failed"] == (len(w) < 50 or 2 * len(again) > len(w))
    assert line_rules.line_frequency_rules(nothing).count() == 0


def test_quality_model(spark, nothing):
    small = "/root/testdata/sf0.01"  # the smallest table has eleven bad labels only
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    rows = quality_model.quality(docs).join(labels, "doc_id").select("quality", "kept").collect()
    right = defaultdict(list)
    for r in rows:
        right[r["quality"]].append(r["kept"] == bool(r["quality"]))
    assert all(sum(x) / len(x) > 0.9 for x in right.values())
    assert quality_model.quality(nothing).count() == 0
    blank = {r["doc_id"]: r["score"] for r in quality_model.quality(docs.limit(50).unionByName(spark.createDataFrame([(-1, None), (-2, "")], "doc_id long, text string"), allowMissingColumns=True)).collect()}
    assert blank[-1] == blank[-2] == 0


def test_pipeline(spark, small):
    import corpus_pipeline
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = corpus_pipeline.run(spark, small)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    n = out.count()
    assert 0.4 * docs.count() < n < docs.count() and n == out.select("doc_id").distinct().count()
    none = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, none, small).schema.fieldNames() == docs.columns



def test_repeated_ids_are_one_document(spark):
    w, v = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    df = spark.createDataFrame([(1, w), (5, v), (7, w), (7, v), (9, "alone")], "doc_id long, text string")
    got = sorted((r["doc_id"], r["component_id"]) for r in set_join.similar_sets(df).collect())
    assert got == [(1, 1), (5, 1), (7, 1), (7, 1), (9, 9)]


def test_fuzzy_lines_keep_columns_of_any_name(spark):
    line = "a line that many documents hold in full"
    df = spark.createDataFrame([(1, f"{line}\nown words here", 7, 8, 9, 10), (2, line, 7, 8, 9, 10)], "doc_id long, text string, _id int, _places int, n_lines int, n_removed int")
    out = fuzzy_lines.remove_fuzzy_lines(df)
    assert sorted(out.columns) == sorted(df.columns)
    got = {r["doc_id"]: (r["text"], r["_id"], r["_places"], r["n_lines"], r["n_removed"]) for r in out.collect()}
    assert got == {1: (f"{line}\nown words here", 7, 8, 2, 0), 2: ("", 7, 8, 1, 1)}


def test_passages_of_repeated_ids(spark):
    """A doc_id that comes with two texts loses nothing of the text that repeats nowhere; equal rows get equal results; ids may be 32-bit."""
    w, v, own = (" ".join(f"{k}{i}" for i in range(60)) for k in "wvx")
    rows = [(1, w), (1, w), (5, f"{own} {w}"), (7, w), (7, v), (7, f"{own} {v}")]
    df = spark.createDataFrame(rows, "doc_id int, text string").repartition(3)
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in automaton_dedup.remove_passages(df).collect())
    assert got == [(1, 60, 0), (1, 60, 0), (5, 120, 60), (7, 60, 0), (7, 60, 60), (7, 120, 60)]
    got = sorted((r["doc_id"], r["n_removed"]) for r in suffix_groups.remove_repeats(df).collect())
    assert [d for d, _ in got] == [1, 1, 5, 7, 7, 7] and got[0] == got[1] == (1, 0) and got[2] == (5, len(w))
    once = [n for d, n in got if d == 7]  # w goes whole, x goes from the third text, v from one of the two
    assert len(w) in once and sum(once) in (len(w) + len(own) + len(v), len(w) + len(own) + len(v) + 1)


def test_decontamination_at_the_limit(spark):
    """Recall at the full edit limit by kind of edit, and for texts shorter than the item; nothing beyond the limit by brute force."""
    rng = random.Random(12)
    vocab = [f"w{i}" for i in range(3000)]
    items = [(k, [rng.choice(vocab) for _ in range(rng.choice((20, 30, 50)))]) for k in range(20)]
    kinds, docs = defaultdict(list), []
    for kind in ("substitution", "deletion", "insertion", "short"):
        for i in range(40):
            k, item = items[i % 20]
            part, most = list(item), len(item) // 5
            if kind == "short":  # the text is the item less its last words
                part = part[:len(part) - rng.randint(1, most)]
            else:
                for _ in range(most if kind == "substitution" else most // 2):
                    at = rng.randrange(len(part))
                    part[at:at + (kind != "insertion")] = [] if kind == "deletion" else [rng.choice(vocab)]
                part = [rng.choice(vocab) for _ in range(40)] + part + [rng.choice(vocab) for _ in range(40)]
            kinds[kind].append((len(docs), k))
            docs.append((len(docs), " ".join(part)))
    docs += [(len(docs), " ".join(items[0][1][:len(items[0][1]) * 3 // 4])), (len(docs) + 1, "w1 w2")]  # shorter than the limit allows
    table = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    found = decontaminate.contaminated(spark.createDataFrame(docs, "doc_id long, text string"), table).collect()
    got = {(r["doc_id"], r["item_id"]) for r in found}
    recall = {kind: sum(x in got for x in want) / len(want) for kind, want in kinds.items()}
    print(recall)
    assert all(x >= 0.9 for x in recall.values())
    body, words_of = dict(docs), dict(items)
    for r in found:
        window = body[r["doc_id"]].split()[r["start"]:r["start"] + r["n_words"]]
        most = len(words_of[r["item_id"]]) // 5
        assert decontaminate.edit_distance(words_of[r["item_id"]], window, most) == r["distance"] <= most


def test_contexts_are_cut_to_recurring_windows():
    """Suffix arrays get only the windows that come again in their group, in the order of the contexts; the bytes to remove stay the same."""
    rng = random.Random(21)
    say = lambda n: bytes(rng.choice(b"abc ") for _ in range(n))
    one, two, own = say(40), say(35), [say(50) for _ in range(4)]
    split = [((1, 1), 0, one + own[0][:10] + two), ((3, 1), 7, own[1] + one + own[0][:10]), ((3, 1), 200, one + b"#" + two), ((4, 1), 5, one)]
    rows = [split, [((2, 1), 0, own[2])], [((5, 1), 0, one), ((6, 1), 0, two)], [((7, 1), 3, own[3] + two), ((8, 1), 9, two + own[2])]]
    cut = list(suffix_groups.recurring(iter(rows), 30))
    assert cut == [[((1, 1), 0, one + own[0][:10] + two[:0]), ((1, 1), 50, two), ((3, 1), 57, one + own[0][:10]), ((3, 1), 200, one), ((3, 1), 241, two), ((4, 1), 5, one)],
                   [((7, 1), 53, two), ((8, 1), 9, two)]]

    def removed(groups):
        return sorted({(d, k) for g in groups for d, start, end in suffix_groups.shard_spans(g, 30) for k in range(start, end)})

    assert removed(cut) == removed(rows) and list(suffix_groups.recurring(iter([]), 30)) == []


def test_lists_of_sets_below_the_limit_give_few_candidates(spark):
    """Near copies whose similarity is below the limit share many lists; their bits keep most pairs from being candidates, and no similar pair is apart."""
    rng = random.Random(31)
    base = [f"w{i}" for i in range(240)]
    rows = []
    for k in range(60):  # each differs from the others in about 20 % of the shingles
        words = list(base)
        for p in range(6):
            words[rng.randrange(240)] = f"x{k}_{p}"
        rows.append((k, " ".join(words)))
    rows.append((90, rows[3][1] + " end"))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = set_join.set_prefixes(docs, 4, 85)
    bits = sets.select(F.col("doc_id").alias("rep"), "n", "bits")
    postings = sets.select(F.col("doc_id").alias("rep"), "n", F.posexplode("prefix").alias("place", "shingle"), F.col("doc_id").alias("comp"), "bits").withColumn("place", F.col("place").cast("long"))
    grams = {d: {tuple(t.split()[i:i + 4]) for i in range(len(t.split()) - 3)} for d, t in rows}
    near = {(a, b) for a in grams for b in grams if a < b and 100 * len(grams[a] & grams[b]) >= 85 * len(grams[a] | grams[b])}
    found = {(r["a"], r["b"]) for r in set_join.list_pairs(postings, 85, leading=False).collect()}
    assert (3, 90) in near and near <= found and len(found) < 61 * 60 // 2 // 4
    every = spark.createDataFrame([(a, b) for a in grams for b in grams if a < b], "a long, b long")
    left = {(r["a"], r["b"]) for r in set_join.not_apart(every, bits, 85).collect()}
    assert near <= left and found <= left


def test_pairs_of_several_slices_are_packed_together(spark):
    """Texts of one task that fill several slices and packs get the scores that they get in tasks of their own."""
    rng = random.Random(41)
    vocab = [f"word{i}" for i in range(3000)]
    rows = [(k, " ".join(rng.choice(vocab) for _ in range(90_000))) for k in range(8)] + [(9, None), (10, "word1 word2 never")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sum(len(t or "") for _, t in rows) > ngram_lm.PACKED
    one, many = ({r["doc_id"]: (r["n_tokens"], r["score"]) for r in ngram_lm.language_model(df.repartition(n, "doc_id")).collect()} for n in (1, 7))
    assert one.keys() == many.keys() == {d for d, _ in rows} and all(one[d][0] == many[d][0] and math.isclose(one[d][1], many[d][1], rel_tol=1e-9) for d in one)


def test_line_signatures(spark):
    """A class has one row, whatever its number of functions; the passes share its buckets, and each function meets a copy's in the same pass."""
    line = " ".join(f"word{i}" for i in range(60))
    rows = [(1, line), (2, line.replace("word30", "word3o")), (3, "a short line"), (4, "x"), (5, "ab" * 300)]
    out = {r["key"]: r for r in fuzzy_lines.signatures(spark.createDataFrame(rows, "key long, text string"), 80).collect()}
    assert sorted(out) == [1, 2, 3, 4, 5] and len(out[4]["buckets0"]) + len(out[4]["buckets1"]) + len(out[4]["buckets2"]) + len(out[4]["buckets3"]) == 10
    parts = {k: [r[f"buckets{p}"] for p in range(fuzzy_lines.PASSES)] for k, r in out.items()}
    assert all(len(set(sum(p, []))) == len(sum(p, [])) for p in parts.values()) and len(sum(parts[1], [])) == 24
    same = [len(set(x) & set(y)) for x, y in zip(parts[1], parts[2])]
    assert sum(same) == len(set(sum(parts[1], [])) & set(sum(parts[2], []))) >= 18
    assert all(0 <= s < len(rows[k - 1][1]) for k in out for p in range(fuzzy_lines.PASSES) for s in out[k][f"spots{p}"])


def test_edit_distances_of_many_pairs():
    """Pairs within the limit, as by the plain table; empty texts, several blocks of rows, other alphabets and lengths in one call."""
    rng, pairs = random.Random(3), [("", ""), ("", "a"), ("a" * 5, "b" * 5)]
    for n in (1, 5, 63, 64, 65, 128, 200, 300):
        for share in (0, 0.1, 0.2, 0.25, 0.4):
            line = "".join(rng.choice("abcdé漢") for _ in range(n))
            out = list(line)
            for _ in range(int(n * share)):
                i, kind = rng.randrange(max(len(out), 1)), rng.random()
                out[i:i + (kind >= 0.3)] = [] if kind > 0.7 else rng.choice("abcxy")
            pairs.append((line, "".join(out)))
    for percent in (50, 80, 90):
        most = [(100 - percent) * max(map(len, p)) // 100 for p in pairs]
        want = [decontaminate.edit_distance(list(a), list(b), m) <= m for (a, b), m in zip(pairs, most)]
        assert edits.within([a for a, _ in pairs], [b for _, b in pairs], percent).tolist() == want and True in want and False in want


def test_lines_that_share_a_run_only_are_no_candidates(spark):
    """Unrelated lines of one vocabulary share runs, but few become candidates; all near copies do, also in a bucket of many of them."""
    rng = random.Random(12)
    vocab = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti", "to", "it", "st", "io", "le", "is", "ou"]
    say = lambda n: " ".join("".join(rng.choice(vocab) for _ in range(rng.randint(1, 4))) for _ in range(n))
    lines = [say(45) for _ in range(1500)]
    base = say(60)
    copies = [base[:k] + "#" + base[k + 1:] for k in rng.sample(range(len(base)), 90)]
    rows = list(enumerate(lines + copies))
    found = fuzzy_lines.candidates(spark.createDataFrame(rows, "key long, text string"), 80).collect()
    pairs = {(r["a"], r["b"]) for r in found}
    assert len({p for p in pairs if p[0] < 1500}) < 600
    assert {k for p in pairs for k in p if k >= 1500} == set(range(1500, 1590)) and any(r["dense"] is not None for r in found)
    assert len([r for r in found if r["a"] >= 1500]) < 90 * 90 * fuzzy_lines.PASSES / 2
    docs = spark.createDataFrame([(k, text) for k, text in rows if k >= 1490], "doc_id long, text string")
    assert sorted(r["doc_id"] for r in fuzzy_lines.remove_fuzzy_lines(docs).collect() if not r["n_removed"]) == list(range(1490, 1501))


def test_written_blocks_are_shuffled_by_some_shards_at_a_time(spark, monkeypatch):
    """With rare words, the blocks are written once and scored a share of the shards at a time; every shard is in one share, and the scores are those of one shuffle."""
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choice("abcdefgh") + str(rng.randrange(40)) for _ in range(60))) for k in range(80)]
    df, written, got = spark.createDataFrame(rows, "doc_id long, text string"), [], {}
    keep = ngram_lm.materialise
    monkeypatch.setattr(ngram_lm, "materialise", lambda d: written.append(d.columns) or keep(d))
    monkeypatch.setattr(ngram_lm, "COMMON", 20)
    for passes in (4, 1):
        monkeypatch.setattr(ngram_lm, "PASSES", passes)
        written.clear()
        got[passes] = {r["doc_id"]: r["score"] for r in ngram_lm.language_model(df).collect()}
        assert written.count(["place", "docs", "sums"]) == passes
    assert got[4].keys() == got[1].keys() and len(got[4]) == 80 and all(math.isclose(got[4][d], got[1][d], rel_tol=1e-9) for d in got[4])


def test_bucket_rows_are_shuffled_packed(spark):
    """A task of one round gets the rows of its buckets as a few packed values, not one by one; over the rounds every class has one row for each function,
    and a round holds a share of all rows, whatever the lengths of the lines."""
    rng = random.Random(14)
    rows = [(k, " ".join("".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(rng.choice((1, 4, 12, 30, 70, 120))))) for k in range(600)]
    classes = spark.createDataFrame(rows, "key long, text string")
    assert len(fuzzy_lines.deals(classes, 80)) == 1  # few rows are one round
    keep, fuzzy_lines.PART = fuzzy_lines.PART, 1
    try:
        rounds = fuzzy_lines.deals(classes, 80)
    finally:
        fuzzy_lines.PART = keep
    total = sum(n for _, n in rounds)
    dealt = sorted((k, p) for deal, _ in rounds for k, parts in deal.items() for p in parts)
    assert len(rounds) > 3 and max(n for _, n in rounds) <= total / fuzzy_lines.ROUNDS + 1 and len(set(dealt)) == len(dealt)
    met = {}
    for deal, n in rounds:
        packed = fuzzy_lines.bucket_table(classes, 80, deal, 5).collect()
        got = [np.frombuffer(r["rows"], fuzzy_lines.ROW) for r in packed]
        assert len(packed) <= 5 * 8 and sum(map(len, got)) == n > 0
        for r in np.concatenate(got):
            met[int(r["key"])] = met.get(int(r["key"]), 0) + 1
    assert sum(met.values()) == total and set(met) == set(range(600)) and all(n >= 10 for n in met.values())


def test_lines_alike_only_next_to_a_run_are_no_candidates(spark):
    """Lines that share a stretch of 60 bytes and nothing else are no candidates; near copies, edited everywhere, are."""
    rng = random.Random(15)
    say = lambda n: "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    shared, lines = say(60), []
    for _ in range(60):
        lines.append(say(175) + shared + say(175))
    base = say(410)
    lines += [base[:k] + "#" + base[k + 1:] for k in rng.sample(range(410), 5)]
    found = {(r["a"], r["b"]) for r in fuzzy_lines.candidates(spark.createDataFrame(list(enumerate(lines)), "key long, text string"), 80).collect()}
    assert not {p for p in found if p[0] < 60} and {k for p in found for k in p} == set(range(60, 65))


def test_edit_distances_of_very_long_lines():
    """Pairs of lines too long to be compared together: the distance itself within the limit, and no more than that it is above it beyond."""
    rng = random.Random(16)
    for n, share in ((0, 0), (1, 0.5), (70, 0.1), (400, 0.2), (400, 0.5)):
        a = [rng.choice("abcdé漢") for _ in range(n)]
        b = [rng.choice("abcxy") if rng.random() < share else c for c in a if rng.random() >= share / 3]
        for most in (0, n // 10, n // 5, n):
            want = decontaminate.edit_distance(a, b, most)
            got = edits.alone("".join(a), "".join(b), most)
            assert got == want if want <= most else got > most
    line = "".join(rng.choice("abcdefgh ") for _ in range(6000))
    near = "".join(rng.choice("xyz") if rng.random() < 0.1 else c for c in line)
    far = "".join(rng.choice("xyz") if rng.random() < 0.3 else c for c in line)
    assert edits.within([line, line, line, "short"], [near, far, line, "shirt"], 80).tolist() == [True, False, True, True]


def test_task_functions_do_not_carry_tables_of_the_driver():
    """Functions are pickled with what they name; the tables that the driver has made for itself are not sent along with every one of them."""
    spans.powers(1000)
    fuzzy_lines.pair_bits()
    for function in (spans.prefix, spans.ranges, fuzzy_lines.bucket_rows):
        sent = cloudpickle.dumps(function)
        assert len(sent) < 200_000
    values = np.arange(50, dtype=np.uint64)
    prefix, ranges = (cloudpickle.loads(cloudpickle.dumps(f)) for f in (spans.prefix, spans.ranges))
    start, end = np.arange(40), np.arange(10, 50)
    assert (ranges(prefix(values), start, end) == spans.ranges(spans.prefix(values), start, end)).all()
