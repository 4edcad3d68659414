"""N-gram join, repeated substrings, packing, mixing, sanitisation, toxicity: against brute force."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from paperweave.llm import mixing, ngram_join, packing, quality_rules, sanitise, suffix_dedup, toxicity
from paperweave.llm.queries import tokenizer_path


def _prose(rnd, n):
    return " ".join("".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(2, 6))) for _ in range(n))


def _edited(rnd, text, changes):
    words = text.split()
    for _ in range(changes):
        words[rnd.randrange(len(words))] = _prose(rnd, 1)
    return " ".join(words)


def _family_rows(seed=1):
    """Originals with near copies at all distances, a chain, a shared passage, exact copies, odd texts."""
    rnd = random.Random(seed)
    rows, i = [], 0
    passage = _prose(rnd, 40)
    for _ in range(25):
        text = _prose(rnd, rnd.randint(8, 220))
        for c in (0, 0, 1, 2, 3, 5, 8):
            rows.append((i, _edited(rnd, text, c)))
            i += 1
    text = _prose(rnd, 120)
    for _ in range(12):  # a chain: neighbours link, the ends do not
        text = _edited(rnd, text, 2)
        rows.append((i, text))
        i += 1
    for n in (2, 10, 60):  # the passage in otherwise different texts
        for _ in range(15):
            rows.append((i, f"{_prose(rnd, n)} {passage} {_prose(rnd, n)}"))
            i += 1
    hot = _prose(rnd, 90)
    rows += [(i + j, _edited(rnd, hot, 1)) for j in range(60)]  # a third of the rows in one group
    i += 60
    odd = [None, "", " \n", "a", "A", "a b c d", "A  B\tc D", "a b c d e", "x " * 3000, "x " * 3001, "é à ü ö ß", "É à ü ö ß"]
    rows += [(i + j, t) for j, t in enumerate(odd)]
    rows += [(rows[3][0], rows[3][1])]  # a repeated row
    return rows


def _shingles(text):
    w = (text or "").encode().lower().split()
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[j:j + 5]) for j in range(len(w) - 4)])


def _join_model(rows):
    sets = [_shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if sets[a] and 100 * common >= 75 * len(sets[a] | sets[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    least = defaultdict(lambda: None)
    for k, (i, _) in enumerate(rows):
        r = find(k)
        least[r] = i if least[r] is None else least[r] if i is None else min(i, least[r])
    return Counter((i, len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows))


@pytest.mark.parametrize("frequent,batch", [(16, 10_000), (2, 40)])
def test_ngram_join(spark, documents, clashing, monkeypatch, frequent, batch):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        rows = _family_rows() + [(None, "lonely words that stand in no other text")]
        got = ngram_join.link_components(documents(rows, clashing).repartition(3)).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert Counter(tuple(r) for r in got) == _join_model(rows)


def test_ngram_join_meets_the_nearest_member_first(documents, monkeypatch):
    """Far copies of a text that link with one member of a large group only: they are not compared with all of it."""
    rng = random.Random(5)
    base = [f"base{i}" for i in range(150)]

    def copy(k, edits):
        words = list(base)
        for slot in rng.sample(range(20), edits):
            words[5 + 7 * slot] = f"own{k}x{slot}"
        return " ".join(words)

    rows = [(k, copy(k, 1 if k == 77 else 2 if k < 150 else 3)) for k in range(200)]
    candidates, countable = [], ngram_join._countable

    def counted(pairs, posted):
        candidates.append(pairs.count())
        return countable(pairs, posted)

    monkeypatch.setattr(ngram_join, "_countable", counted)
    got = ngram_join.link_components(documents(rows)).collect()
    assert Counter(tuple(r) for r in got) == _join_model(rows)
    assert sum(candidates) <= 10 * len(rows), candidates


def test_ngram_order_counts_tokens_over_all_tasks(documents, monkeypatch):
    """A passage of many texts is frequent however the texts are dealt: here no task holds two of them."""
    monkeypatch.setattr(ngram_join, "ORDER_SAMPLE", 1)
    rows = [(k, f"own{k} words{k} six common words stand in here own{k} more{k}") for k in range(24)]
    docs = ngram_join.workers_import(documents(rows)).repartitionByRange(24, "doc_id").select("text")
    held = ngram_join.frequent_tokens(docs)
    every = [set(ngram_join.shingle_set(t).tolist()) for _, t in rows]
    assert set(held.tolist()) == set.intersection(*every) and len(held) == 2


def test_ngram_join_keeps_one(documents, clashing):
    rows = _family_rows(2)
    df = documents(rows, clashing)
    out = ngram_join.keep_one(df)
    assert out.columns == df.columns
    model = _join_model(rows)
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(i for i, _, c in model.elements() if i == c)


def _removal_model(rows):
    raws = [(t or "").encode() for _, t in rows]
    count = Counter(r[p:p + 200] for r in raws for p in range(len(r) - 199))
    out = Counter()
    for (i, _), raw in zip(rows, raws):
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - 199):
            if count[raw[p:p + 200]] > 1:
                gone[p:p + 200] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone]) if raw else b""
        out[(i, len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def _repeat_rows():
    rnd = random.Random(3)
    line, passage = _prose(rnd, 30), _prose(rnd, 80)
    rows = [(i, f"{_prose(rnd, 50)} {passage} {_prose(rnd, 50)}") for i in range(12)]
    rows += [(20 + i, f"{_prose(rnd, rnd.randint(5, 30))}\n{line}\n{_prose(rnd, 20)}") for i in range(20)]
    text = _prose(rnd, 300)
    rows += [(50 + i, _edited(rnd, text, i)) for i in range(6)]
    rows += [(60, text), (60, text), (None, text[:199]), (61, text[100:300]), (62, text[100:299])]
    rows += [(70, "ab" * 400), (71, "é" * 150), (72, "a" * 199), (73, "a" * 200), (74, None), (75, ""), (76, passage + passage)]
    rows += [(77, "x" + text + "y"), (78, _prose(rnd, 8000))]
    return rows


@pytest.mark.parametrize("hot,stretch", [(1000, 2_000_000), (2, 700)])
def test_repeated_substrings(spark, documents, clashing, monkeypatch, hot, stretch):
    monkeypatch.setattr(suffix_dedup, "HOT_RUNS", hot)
    monkeypatch.setattr(suffix_dedup, "STRETCH", stretch)
    rows = _repeat_rows()
    got = suffix_dedup.remove_repeats(documents(rows, clashing).repartition(4)).collect()
    assert Counter(tuple(r) for r in got) == _removal_model(rows)


@pytest.mark.parametrize("batches", [1, 3])
def test_anchors_and_names(batches):
    rng = np.random.default_rng(5)
    data = rng.integers(97, 97 + batches + 1, size=2000, dtype=np.uint8)
    grams = suffix_dedup.gram_names(data)
    at = suffix_dedup.anchors(grams)
    assert len(at) == 2000 - 199
    assert all(at[p] == p + int(np.argmin(grams[p:p + 151])) for p in range(len(at)))
    strings = {}
    for p, g in enumerate(grams):
        assert strings.setdefault(int(g), bytes(data[p:p + 50])) == bytes(data[p:p + 50])


def test_remaining_texts_of_all_documents(documents):
    rnd = random.Random(12)
    twice = _prose(rnd, 120)
    rows = [(1, "head " + twice), (2, twice + " tail"), (3, _prose(rnd, 200)), (4, "short é"), (5, ""), (6, None), (None, "no id")]
    df = documents(rows)
    got = suffix_dedup.remove_repeats(df, with_text=True).collect()
    assert len(got) == len(rows)
    kept = {r["doc_id"]: bytes(r["kept"]) for r in got}
    assert all(kept[i] == (t or "").encode() for i, t in rows[2:])
    assert len(kept[1]) < 30 and len(kept[2]) < 30
    columns = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert Counter(tuple(r[c] for c in columns) for r in got) == Counter(map(tuple, suffix_dedup.remove_repeats(df).select(columns).collect()))


def test_empty_tables(documents):
    empty = documents([])
    assert ngram_join.link_components(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert packing.pack_documents(empty, tokenizer_path()).count() == 0
    assert mixing.mix(empty).count() == 0
    assert sanitise.span_report(empty).count() == 0
    labels = empty.select("doc_id", F.lit(1).alias("quality"), F.lit(1).alias("toxic"))
    assert toxicity.learn(empty, labels) is None
    assert toxicity.score_documents(empty, None).count() == 0


PACK_TEXTS = [
    None, "", "a", " a", "a  b", "line one\nline two", "x<|endoftext|>y", "tab\tand\r\nmore\n\n", "it's they've, 'quoted' 12,345.", "ends ", "\n",
    "日本語 テキスト é ü", "unit\x1csep", "word " * 9000, "z" * 5000, "one. two, three; four: five! six?",
]


def _ids(text):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path()).encode(text or "", add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("parts,open_windows", [(1, 16), (6, 2)])
def test_packing(documents, clashing, parts, open_windows):
    rnd = random.Random(4)
    rows = list(enumerate(PACK_TEXTS)) + [(100 + i, _prose(rnd, int(rnd.lognormvariate(5, 1.3)) + 1)) for i in range(150)]
    rows += [(None, "no id"), (100, "another row of this id")]
    df = documents(rows, clashing).repartition(parts)
    got = packing.pack_documents(df, tokenizer_path(), open_windows=open_windows, fan=3).collect()
    pieces, windows = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[(r["doc_id"], r["doc_tokens"])].append((r["start"], r["length"], r["ids_crc32"]))
        windows[r["sequence_id"]].append((r["offset"], r["length"]))
    expected = {}
    for i, t in rows:
        ids = _ids(t)
        expected[(i, len(ids))] = ids
    assert set(pieces) == set(expected)
    for key, ids in expected.items():
        at = 0
        for start, length, crc in sorted(pieces[key]):
            assert start == at
            assert crc == zlib.crc32(struct.pack(f"<{length}I", *ids[start:start + length]))
            at += length
        assert at == len(ids)
    short = 0
    for members in windows.values():
        at = 0
        for offset, length in sorted(members):
            assert offset == at
            at += length
        assert at <= 2048
        short += at < 2048 - packing.SLACK
    assert short <= 1  # one unfilled window in all
    again = packing.pack_documents(df, tokenizer_path(), open_windows=open_windows, fan=3).collect()
    assert Counter(again) == Counter(got)


@pytest.mark.parametrize("text", [
    "a\tb\tc\n\n", "a\tb\tc\n\n\nd", "a\tb \t c", "prix\u00a0: 3\n\nfin", "x\r\ny  z\tw", "a\u2009b\n\nc", "a\x1cb\n\nc", "a b\nc d", "a \nb", "a\n b", "a\u3000b\n\n",
])
def test_ids_of_any_white_space(text):
    assert list(struct.unpack(f"<{len(_ids(text)) - 1}I", packing.encoder(tokenizer_path()).encode(text))) == _ids(text)[:-1]


def _target_model(sizes):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: float(i % 3 + 1) for i, s in enumerate(order)}
    left, free, target = float(sum(sizes.values())), set(order), {}
    while free:
        share = left / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] > 3 * sizes[s]]
        for s in over or free:
            target[s] = 3.0 * sizes[s] if over else share * weight[s]
        free -= set(over or free)
        left = sum(sizes.values()) - sum(target.values())
    return target


def test_mixing(documents, clashing):
    rnd = random.Random(6)
    rows, i = [], 0
    for source, n, words in (("a", 90, 30), ("b", 4, 10), (None, 30, 60), ("", 20, 5), ("zé", 10, 400), ("empty", 3, 0)):
        for _ in range(n):
            rows.append((i, _prose(rnd, rnd.randint(0, words)), "en", source))
            i += 1
    rows += [(i, "one two three", "en", "a")] * 3 + [(None, "no id here", "en", "b"), (i + 1, None, "en", "a")]
    df = documents(rows, clashing)
    got = mixing.mix(df).drop("rank").collect()
    size = lambda t: len(re.findall("[^\x20\x09-\x0D]+", t or ""))
    sizes = Counter()
    for _, t, _, s in rows:
        sizes[s] += size(t)
    for s in {r[3] for r in rows}:
        sizes[s] += 0
    target = _target_model(sizes)
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in got) == Counter((r[0], r[3], size(r[1])) for r in rows)
    taken, largest = Counter(), Counter()
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in sizes:
        assert abs(taken[s] - target[s]) <= max(1, largest[s] / 2), (s, taken[s], target[s])
    assert Counter(mixing.mix(df.repartition(5)).drop("rank").collect()) == Counter(got)
    mixed = mixing.mixed_documents(df)
    assert mixed.columns == df.columns
    assert Counter(r["doc_id"] for r in mixed.collect() if r["doc_id"] is not None and r["doc_id"] < i) == Counter(
        {r["doc_id"]: r["copies"] for r in got if r["copies"] and r["doc_id"] is not None and r["doc_id"] < i})


def test_stages_decide_by_row(documents):
    rnd = random.Random(16)
    text = _prose(rnd, 60)
    rows = [(None, text, "en", "a"), (None, text + " end", "en", "a"), (7, "too short", "en", "a"), (7, _prose(rnd, 40), "en", "b"), (None, "short", "en", "b")]
    rows += [(None, _prose(rnd, 30), "en", "c") for _ in range(20)]
    df = documents(rows)
    assert Counter(r["text"] for r in ngram_join.keep_one(df).collect()) == Counter([text] + [r[1] for r in rows[2:]])
    assert Counter(r["text"] for r in quality_rules.keep_good(df).collect()) == Counter(r[1] for r in rows if len(r[1].split()) >= 10)
    planned, taken = Counter(), Counter()
    for r in mixing.mix(df).collect():
        planned[r["source"]] += r["taken"]
    for r in mixing.mixed_documents(df).collect():
        taken[r["source"]] += len(r["text"].split())
    assert taken == +planned


def test_newton_solves_the_dual(spark):
    df = spark.createDataFrame([("a", 100.0, 300.0), ("b", 1e9, 3.0), ("c", 50.0, 0.0), ("d", 0.0, 0.0)], "source string, source_size double, target double")
    rate = {r["source"]: r["rate"] for r in mixing.dual_multipliers(df).collect()}
    assert rate["a"] == pytest.approx(3, rel=1e-9) and rate["b"] == pytest.approx(3e-9, rel=1e-9) and rate["c"] == rate["d"] == 0


PII_TEXTS = [
    None, "", "mail a.b+c@x-y.example.org, or a@b@c.d and e@f", "a@b.c_d@e.f g@h.", "@x.y a@.b %@1.2.3", "ip 1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 001.02.3.4",
    "card 4111 1111 1111 1111 and 4111-1111-1111-1112, 49927398716000", "+1 (977) 555-3400 +123 +12345678901234567 ++49 30 1234567", "+1-2.3(4)5 67890 x",
    "é@ü.de ünï@example.com", "1" * 5000 + " " + "a" * 5000 + "@", "9" * 16 + "@1.1.1.1",
]


def _pattern_model(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(sum(divmod(int(c) * 2, 10)) if k % 2 else int(c) for k, c in enumerate(d[::-1])) % 10 == 0

    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda s: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda s: all(int(p) <= 255 for p in s.split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda s: 14 <= len(digits(s)) <= 19 and luhn(digits(s))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda s: 10 <= len(digits(s)) <= 15),
    ]
    found = [(m.start(), k, f"{n}:{m.start()}:{m.end()}") for k, (n, p, ok) in enumerate(rules) for m in re.finditer(p, text) if ok(m[0])]
    return ",".join(f[2] for f in sorted(found))


def test_patterns(documents, clashing):
    rows = list(enumerate(PII_TEXTS)) + [(0, "x@y.zz"), (None, "x@y.zz")]
    got = sanitise.span_report(documents(rows, clashing)).collect()
    expected = Counter((i, s, hashlib.sha256(s.encode()).hexdigest()) for i, t in rows for s in [_pattern_model(t)])
    assert Counter((r["doc_id"], r["spans"], r["base_sha256"]) for r in got) == expected
    for r in got:
        assert [r[f"n_{k}"] for k in sanitise.KINDS] == [sum(x.startswith(k + ":") for x in r["spans"].split(",")) for k in sanitise.KINDS]


def test_telling_terms_need_independent_evidence(documents):
    rnd = random.Random(8)
    other = lambda: " ".join(rnd.choice("alpha beta gamma delta omega sigma kappa theta".split()) for _ in range(6))
    rows = [(i, f"{other()} Quillon writes from q@mail.example.com {other()}") for i in range(8)]
    copied = f"{other()} Zebulon writes from z@mail.example.com {other()}"
    rows += [(100 + i, copied) for i in range(30)]  # one context, thirty times
    rows += [(200 + i, other()) for i in range(60)]
    df = documents(rows)
    got = {r["doc_id"]: r for r in sanitise.span_report(df).collect()}
    for i in range(8):
        at = rows[i][1].index("Quillon")
        assert f"term:{at}:{at + 7}" in got[i]["spans"].split(",")
    assert all(got[100 + i]["n_term"] == 0 for i in range(30))
    assert all(got[i]["n_term"] == 0 for i in range(200, 260))
    clean = {r["doc_id"]: r["text"] for r in sanitise.sanitise(df).collect()}
    assert "Quillon" not in clean[0] and "[NAME]" in clean[0] and "[EMAIL]" in clean[0] and "@" not in clean[0]
    assert "Zebulon" in clean[100] and clean[200] == rows[38][1]


def test_telling_terms_are_marked_wherever_they_stand(documents):
    rnd = random.Random(18)
    other = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(3)) for _ in range(n))
    rows = [(i, f"Quillon {other(30)} q@mail.example.com {other(20)} quillon") for i in range(8)]  # far from the find
    rows += [(100, f"{other(20)} Quillon {other(5)}"), (101, None), (None, f"quillon {other(9)}")]  # without the entity
    rows += [(200 + i, f"Zebulon {other(1)} letter to z{i}@mail.example.com") for i in range(2)]  # too little evidence
    rows += [(300 + i, "Form Yardley sends from y@mail.example.com to all") for i in range(40)]  # one text
    rows += [(400 + i, other(30)) for i in range(200)]
    got = {r["doc_id"]: r for r in sanitise.span_report(documents(rows)).collect()}
    for i, text in rows:
        places = [m.span() for m in re.finditer("quillon", text or "", re.I)]
        assert [x for x in got[i]["spans"].split(",") if x.startswith("term:")] == [f"term:{s}:{e}" for s, e in places], i


def test_rows_that_share_an_identifier_are_sanitised_apart(documents):
    rows = [(1, "one a@b.cc end"), (1, "other text c@d.ee"), (1, "nothing to find in this row"), (None, "x@y.zz"), (None, "no find at all"),
            (None, "card 4111 1111 1111 1111"), (2, None)]
    got = Counter((r["doc_id"], r["text"]) for r in sanitise.sanitise(documents(rows)).collect())
    assert got == Counter([(1, "one [EMAIL] end"), (1, "other text [EMAIL]"), (1, rows[2][1]), (None, "[EMAIL]"), (None, "no find at all"),
                           (None, "card [CARD]"), (2, None)])


def _disclosure_model(texts, cfg):
    """Every (entity, term) pair beyond the thresholds, all pairs counted over the distinct texts."""
    held, entity, both, seen = Counter(), Counter(), Counter(), {}
    for text in texts:
        spans = sanitise.pattern_spans(text or "")
        known, terms = seen.setdefault(sanitise.lowered(text or "", spans), (set(), set()))
        known.update(x for _, k, _, v in spans for x in sanitise.entities_of(k, v))
        terms.update(sanitise.lowered(text or "", spans).split())
    for known, terms in seen.values():
        held.update(terms)
        entity.update(known)
        both.update((e, t) for e in known for t in terms)
    tests, out = len(entity) * len({t for _, t in both}), set()
    for (e, t), n in both.items():
        q, p = n / held[t], entity[e] / len(seen)
        tail = held[t] * (q * math.log(q / p) + ((1 - q) * math.log((1 - q) / (1 - p)) if q < 1 else 0))
        if q >= cfg.posterior and math.log2(q / p) >= cfg.bits and math.log(tests) - tail <= math.log(cfg.alpha):
            out.add((e, t, round(q, 9), round(math.log2(q / p), 9)))
    return out


def _disclosing_rows():
    rnd = random.Random(28)
    other = lambda n: " ".join("".join(rnd.choice("abcdefgh") for _ in range(3)) for _ in range(n))
    rows = [(i, f"{other(9)} Quillon {other(9)} q@mail.example.com") for i in range(8)]  # reveals an address
    rows += [(50 + i, f"Orgalon {other(12)} w{i}@orga.example.com {other(3)}") for i in range(9)]  # reveals a domain, no address
    rows += [(70 + i, f"{other(7)} Serveron at 10.20.30.{i}") for i in range(7)]  # a network
    rows += [(80 + i, f"{other(7)} Callaron +1 (212) 555-01{i:02d}, {other(2)}") for i in range(7)]  # an area
    rows += [(90, f"Orgalon and quillon {other(4)}"), (91, None), (92, ""), (None, f"serveron {other(5)}"), (90, f"callaron {other(6)}")]
    rows += [(100 + i, rows[0][1]) for i in range(25)] + [(200 + i, other(25)) for i in range(250)]
    return rows


@pytest.mark.parametrize("held", [32 << 20, 0])
def test_disclosed_terms_are_those_of_all_pairs_counted(documents, clashing, held):
    cfg, rows = sanitise.Disclosure(broadcast_bytes=held), _disclosing_rows()
    df = documents(rows, clashing)
    told = sanitise.disclosures(df.select("text"), cfg).collect()
    expected = _disclosure_model([t for _, t in rows], cfg)
    assert len(told) == len(expected) and {(r["entity"], r["term"], round(r["posterior"], 9), round(r["bits"], 9)) for r in told} == expected
    kinds: dict[str, int] = {}
    for e, t, *_ in expected:
        kinds[t] = min(kinds.get(t, 99), e % 16)
    assert {"quillon": 4, "orgalon": 5, "serveron": 6, "callaron": 8}.items() <= kinds.items()

    def model(text):
        finds = sanitise.pattern_spans(text or "")
        return ",".join(f"{(*sanitise.KINDS, 'term')[min(k, 4)]}:{s}:{e}" for s, k, e in sorted(
            [f[:3] for f in finds] + [(s, kinds[text[s:e].lower()], e) for s, e in sanitise.free_words(text or "", finds) if text[s:e].lower() in kinds]))

    got = Counter((r["doc_id"], r["spans"]) for r in sanitise.span_report(df, cfg).collect())
    assert got == Counter((i, model(t)) for i, t in rows)
    out = sanitise.sanitise(df, cfg)
    assert out.columns == df.columns
    clean = Counter(r["text"] for r in out.filter("doc_id < 100 or doc_id is null").collect())
    texts = " ".join(t or "" for t in clean)
    assert clean[None] == 1 and clean[""] == 1 and not any(w in texts.lower() for w in ("quillon", "orgalon", "serveron", "callaron", "@"))
    assert all(f"[{w}]" in texts for w in ("NAME", "TERM", "ORGANISATION", "NETWORK", "REGION", "EMAIL", "IP", "PHONE"))


def _toxic_rows(n, seed):
    rnd = random.Random(seed)
    rows, labels = [], []
    bad = ["vileword", "nastiness", "hatefulthing", "scumbaggy"]
    for i in range(n):
        words = _prose(rnd, rnd.randint(20, 150)).split()
        toxic = i % 3 == 0
        if toxic:
            for _ in range(4):
                words.insert(rnd.randrange(len(words)), rnd.choice(bad))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark, documents, clashing):
    rows, labels = _toxic_rows(900, 9)
    rows += [(2000, None), (2001, ""), (None, "plain words"), (2002, "x" * 50_000), (2002, "x" * 50_000)]
    labels += [(None, 1, 1), (5000, 0, None), (1, 1, 0)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    df = documents(rows, clashing)
    model = toxicity.learn(df, table)
    got = toxicity.score_documents(df, model).collect()
    assert len(got) == len(rows)
    truth = {i: t for i, _, t in labels if i is not None}
    held = [r for r in got if r["held_out"] and r["doc_id"] in truth and r["doc_id"] < 2000]
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in got)
    assert len(held) > 100
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in held) / len(held)
    assert right >= 0.95, right
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    assert len({r["score"] for r in got if r["doc_id"] == 2002}) == 1
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] in (2000, 2001, None))
    # held-out labels are never read: other labels there give the same model
    flipped = [(i, q, 1 - t if i is not None and t is not None and zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in labels]
    other = toxicity.learn(df, spark.createDataFrame(flipped, "doc_id long, quality int, toxic int"))
    assert other.toxic == model.toxic and np.allclose(other.weights, model.weights)
