"""Each operator against a plain version, on fixtures with nulls, empty and long texts, ties, repeated
rows, empty tables and extra columns with clashing names."""
import collections
import hashlib
import json
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from voxspark.llm import (capfilter, chat, decontaminate, html_extract, jaccard, packing, pii, pretokens, quality, sharding,
                          token_count)
from voxspark.llm.queries import tokenizer

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
R = random.Random(5)
WORDS = ["".join(R.choice("abcdeilnorst") for _ in range(R.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def edited(text, k, seed):
    r, w = random.Random(seed), text.split()
    for _ in range(k):
        w[r.randrange(len(w))] = r.choice(WORDS)
    return " ".join(w)


def documents(spark, texts):
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts]
    # the names of internal columns stand as extra columns
    return spark.createDataFrame(rows, DOCS).withColumns({k: F.lit("x") for k in ("key", "id", "h", "slot", "cls", "base", "__key2")})


ODD = [(900, None), (901, ""), (902, " \n\t"), (903, "one"), (904, "a b c"), (905, "A B c"), (906, prose(9000, 1)), (906, prose(9000, 1)),
       (None, prose(30, 2)), (None, prose(30, 3)), (907, "ü€😀 " * 50)]


# 1 ---------------------------------------------------------------------------------------------------------------------
def test_shard_table_is_even_and_moves_little():
    names = [f"s{i}" for i in range(10)]
    a = sharding.fill(names, 1009)
    share = collections.Counter(a)
    assert max(share.values()) - min(share.values()) <= 1 and set(a) == set(range(10))
    b = sharding.fill(names[:-1], 1009)
    assert sum(x != y for x, y in zip(a, b) if x != 9) < 0.25 * 1009
    with pytest.raises(ValueError):
        sharding.fill(names, 1000)


def test_shard_rows(spark):
    df = documents(spark, ODD)
    got = sharding.shard(df, "doc_id", ["a", "b", "c"], 101).collect()
    table = sharding.fill(["a", "b", "c"], 101)
    assert len(got) == len(ODD)
    for r in got:
        key = "" if r.doc_id is None else str(r.doc_id)
        slot = int(hashlib.md5(key.encode()).hexdigest()[:15], 16) % 101
        assert (r.slot, r.shard_id) == (slot, table[slot])
    assert sharding.shard(df.limit(0), "doc_id", ["a"], 101).count() == 0


# 2 ---------------------------------------------------------------------------------------------------------------------
def test_masks_are_lossless():
    assert decontaminate.lossless() and not decontaminate.lossless(masks=((0, 1, 2, 3, 4, 5, 6, 7),))


def brute_overlaps(docs, items, window=13, errors=2):
    toks = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    out = {}
    for d, t in docs:
        h = toks(t)
        for i, u in items:
            g = toks(u)
            for diag in range(-len(g) + window, len(h) - window + 1) if len(g) >= window else ():
                same = [0 <= diag + q < len(h) and h[diag + q] == x for q, x in enumerate(g)]
                if any(sum(same[s:s + window]) >= window - errors
                       for s in range(max(0, -diag), min(len(g), len(h) - diag) - window + 1)):
                    out[(d, i)] = max(out.get((d, i), 0), sum(same))
    return out


def test_decontamination(spark):
    items = [(0, prose(30, 50)), (1, prose(13, 51)), (2, prose(12, 52)), (3, None), (4, prose(30, 50))]
    docs = [(i, prose(60, 100 + i)) for i in range(20)] + [
        (30, prose(20, 7) + " " + items[0][1].upper() + ". " + prose(20, 8)), (31, edited(items[0][1], 2, 1)),
        (32, edited(items[0][1], 9, 2)), (33, items[1][1]), (34, items[2][1]), (35, " ".join(items[0][1].split()[:14])),
        (36, (items[1][1] + " ") * 3)] + [x for x in ODD if x[0] not in (906, None)]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = {(r.id, r.item): r.matched for r in decontaminate.overlaps(documents(spark, docs), bench).collect()}
    assert got == brute_overlaps(docs, items) and {(30, 0), (30, 4), (33, 1)} <= set(got)
    left = {r.doc_id for r in decontaminate.clean(documents(spark, docs), bench).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in got}
    assert decontaminate.overlaps(documents(spark, docs), bench.limit(0)).count() == 0


def test_decontamination_of_short_items(spark, tmp_path):
    """Items below the window, and scripts without spaces, in the operator and in the pipeline's stage."""
    for n in range(1, 13):
        mask, errors = decontaminate.short_plan(n)
        assert decontaminate.lossless((mask,), n, errors) and (errors == 0 or len(mask) >= decontaminate.LEAST_MASK)
    words = [f"w{i}" for i in range(40)]
    text = lambda *k: " ".join(words[i] for i in k)
    items = [(0, text(*range(12))), (1, text(*range(20, 25))), (2, "solo"), (3, "中国的首都是哪一座城市"), (4, "เมืองหลวงของประเทศไทย"), (5, "?!"), (6, None),
             (7, "日本の首都はどこですか東京です")]
    docs = [(0, "a " + text(*range(12)).upper() + ". b"), (1, text(0, 1, 2, 3, 4, 39, 6, 7, 8, 9, 10, 11)), (2, text(0, 1, 38, 3, 4, 39, 6, 7, 8, 9, 10, 11)),
            (3, text(19, 20, 21, 22, 23, 24, 30)), (4, text(20, 21, 30, 23, 24)), (5, "b Solo a"), (6, "solos"), (7, "问题：中国的首都是哪一座城市？"),
            (8, "中国的首都"), (9, "x เมืองหลวงของประเทศไทย y"), (10, "a b c"), (11, None), (12, "日本の首都はどこですか東京です。")]
    want = {(0, 0), (1, 0), (3, 1), (5, 2), (7, 3), (9, 4), (12, 7)}
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate.overlaps(documents(spark, docs), bench, short=True).collect()
    assert {(r.id, r.item) for r in got} == want and {r.first_token for r in got if r.id in (0, 3)} == {1}
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    left = {r.doc_id for r in corpus_pipeline.decontaminate_stage(spark, documents(spark, docs), str(tmp_path)).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in want}


# 3 ---------------------------------------------------------------------------------------------------------------------
def brute_groups(rows, n, num, den):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append(frozenset(tuple(w[k:k + n]) for k in range(max(1, len(w) - n + 1))) if w else frozenset())
    comp = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and both * den >= num * len(sets[i] | sets[j]) and comp[i] != comp[j]:
                a, b = comp[i], comp[j]
                comp = [b if c == a else c for c in comp]
    ids = collections.defaultdict(list)
    for c, (i, _) in zip(comp, rows):
        ids[c].append(i)
    low = {c: min((x for x in v if x is not None), default=None) for c, v in ids.items()}
    return sorted(((i, len(s), low[c]) for (i, _), s, c in zip(rows, sets, comp)), key=str)


@pytest.mark.parametrize("n,num,crowd", [(4, 85, 32), (5, 80, 2)])
def test_jaccard_groups(spark, n, num, crowd):
    """Families with edits, short sets, a shared passage; with a tiny ``crowd`` every family is crowded."""
    base, passage = prose(120, 11), prose(40, 12)
    rows = [(i, edited(base, i % 9, i)) for i in range(60)] + [(100 + i, passage + " " + prose(8 + i, 200 + i)) for i in range(25)]
    rows += [(200 + i, edited(prose(9 + i % 4, 300 + i // 5), i % 2, i)) for i in range(60)] + [(300 + i, prose(70, 400)) for i in range(5)]
    rows += [(400 + i, " ".join(prose(16, 500).split()[:12 + i])) for i in range(5)] + ODD
    df = documents(spark, rows)
    got = jaccard.groups(df, n=n, num=num, den=100, crowd=crowd, block=8).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_groups(rows, n, num, 100)


def test_jaccard_empty(spark):
    assert jaccard.groups(documents(spark, ODD).limit(0)).count() == 0


def test_sketches_never_rule_out_wrongly():
    r = np.random.default_rng(1)
    for _ in range(200):
        a = np.unique(r.integers(0, 2 ** 63, 100).astype(np.uint64))
        b = np.unique(np.concatenate([a[r.integers(0, 40):], r.integers(0, 2 ** 63, 20).astype(np.uint64)]))
        x, y = (np.frombuffer(jaccard.sketch(v), np.uint64) for v in (a, b))
        assert jaccard._bits(x, y) <= len(np.setxor1d(a, b))


def test_sketches_of_different_widths():
    r = np.random.default_rng(2)
    a = np.unique(r.integers(0, 2 ** 63, 600).astype(np.uint64))
    x, y = (np.frombuffer(jaccard.sketch(v), np.uint64) for v in (a, a[:500]))
    assert (len(x), len(y)) == (16, 8)
    assert jaccard._bits(jaccard._folded(x, 8), jaccard._folded(y, 16)) <= 100
    for size in (256, 257, 5000):
        s = np.unique(r.integers(0, 2 ** 63, size).astype(np.uint64))
        assert jaccard._bits(*[np.frombuffer(jaccard.sketch(v), np.uint64) for v in (s, s)]) == 0


# 4 ---------------------------------------------------------------------------------------------------------------------
def test_chat_layouts():
    table = chat.mappings()
    turns = lambda x: chat.turns_of(x, table)[1:]
    want = [("system", "s"), ("user", "q"), ("assistant", "a")]
    assert turns({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}], "system": "s"}) == ("shares", want)
    assert turns({"instruction": "q", "input": "x", "output": "a"}) == ("instruction", [("user", "q\n\nx"), ("assistant", "a")])
    assert turns({"prompt": "q", "response": "a", "system": "s"}) == ("prompt", want)
    assert turns({"messages": [{"role": "user", "content": "q"}]}) == ("messages", [("user", "q")])
    assert turns({"question": "q", "answer": "a"}) == ("question", [("user", "q"), ("assistant", "a")])
    assert turns({"what": 1}) == (None, []) and turns([1]) == (None, []) and turns({"messages": []}) == ("messages", [])


def test_chat_round_trip(spark):
    r = random.Random(3)
    bits = ["</s>", "<s>", "[INST]", "[/INST]", "<|turn|>", "<|text|>", "<\\/s>", "[\\\\INST]", "<", "[", "\\", "a", "é😀", "\n", "<<SYS>>"]
    rows = [(c, t, r.choice(["user", "assistant", "system", None, "a<|text|>\nb"]), r.choice([None, "", "".join(r.choices(bits, k=12))]))
            for c in [*range(40), None] for t in range(r.randint(1, 6))] + [(1, 1, "assistant", "tie"), (1, 1, "assistant", "tie")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("part", F.lit("x"))
    records = df.select("*", F.to_json(F.struct("role", "text")).alias("payload"))
    pieces = chat.formatted(chat.canonical_turns(records, "conv_id", "turn", "payload"))
    for p in pieces.collect():
        inner = p.formatted[len(chat.TURN):-len(chat.END)].replace(chat.TEXT, "", 1)
        assert not any(re.search(r"[<\[]" + c, inner) for c in chat.CONTROLS)
    got = {x.conv_id: x for x in chat.read_back(pieces).collect()}
    by = collections.defaultdict(list)
    for c, t, role, text in rows:
        by[c].append((t, role or "", text or ""))
    assert set(got) == set(by)
    for c, turns in by.items():
        turns.sort()
        said = "".join(x for _, role, x in turns if role == "assistant")
        assert got[c].n_turns == len(turns) and got[c].loss_chars == len(said)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
    bad = spark.createDataFrame([(1, "no json"), (2, None), (3, json.dumps({"x": 1}))], "c long, p string")
    assert [x.layout for x in chat.canonical_turns(bad, "c", None, "p").collect()] == [None] * 3
    assert chat.read_back(pieces.limit(0)).count() == 0


# 5 ---------------------------------------------------------------------------------------------------------------------
LINKS = "<ul>" + "<li><a>l</a></li>" * 4 + "</ul>"


@pytest.mark.parametrize("page,text", [
    (None, ""), ("", ""), ("plain words only here", "plain words only here"), ("<article>", ""), ("<p>cut <a href", "cut"),
    ("<nav><a>menu</a></nav><article><h1>T &amp; t</h1><p>one\n two<p><b>three</article><footer>f</footer>", "T & t\none two\nthree"),
    ("<body><header>Site</header><main><p>a b c.</p><aside>side</aside><form>q <input></form><p>d</p></main>", "a b c.\nd"),
    ("<article><p>x y</p><div class='ad'>buy</div><section id=comments><p>first!</p></section><p>z<script>var a='</p>';</script></article>", "x y\nz"),
    ("<div class='cookie-notice'>We use</div><div><p>" + "long text " * 20 + "</p><p>and more of it</p></div><ul><li><a>l</a></li></ul>",
     ("long text " * 20).strip() + "\nand more of it"),
    ("<nav><a>menu</a></nav><article><h1><a href=x>Linked head</a></h1><p>some text</p><h2><a>Part</a></h2><ul><li><a>one link</a><li>b</ul>"
     "<table><tr><td><a>cell</a></td></tr></table><aside><a>aside</a></aside></article><p><a>out</a></p>",
     "Linked head\nsome text\nPart\none link\nb\ncell"),
    ("<main><h1><a>Only</a></h1></main><p>outside</p>", "Only"),
    ("<datalist><option>a<option>b</datalist><article><p>kept text</p></article>", "kept text"),
    ("<button>Search<article><p>x</p><button>y</button><svg><path><text>n</text><p>z</p></article>", "x\nz"),
    ("<video src=v>no video<div><main><p>x <object><param>no object</p><map name=m><area><p>y</p></main></div>", "x\ny"),
    ("<p>a</p><script>var x = '<p>b</p>'", "a"), ("<p>a<select><option>u<option>v</select> b <svg><svg></svg>t</svg>c</p>", "a b c"),
    ("<body class='site no-sidebar'><div class='content has-sidebar with-nav'><div class='elementor-widget'><p>text</p></div>"
     "<div class='main-sidebar'>s</div><div class='elementor-widget elementor-widget-nav-menu'>n</div></div>", "text"),
    ("<article><section id='related-work' class='menu-of-the-day'><p>text</p></section><div class='related-posts'>r</div>"
     "<div class='share-buttons x'>s</div><div id=comment-list>c</div></article>", "text"),
    ("<p>" + "a" * 200 + "</p>" + LINKS + "<p>short</p>" + LINKS + "<p>" + "b" * 100 + "</p>" + LINKS + "<p>" + "c" * 30 + "</p>" + LINKS + "<p>d</p>",
     "\n".join(["a" * 200, "short", "b" * 100, "c" * 30])),
    ("<article>" + "<p><b>w" * 3000 + "</article>", "\n".join(["w"] * 3000)),
])
def test_html(page, text):
    assert html_extract.main_text(page) == text


def test_html_rows(spark):
    df = spark.createDataFrame([(1, "u", "<p>é</p>"), (1, "u", "<p>é</p>"), (None, None, None)], "page_id long, url string, html string")
    assert sorted((r.page_id or 0, r.text, r.n_chars) for r in html_extract.extract(df).collect()) == [(0, "", 0), (1, "é", 1), (1, "é", 1)]
    assert html_extract.extract(df.limit(0)).count() == 0


# 6, 9 ------------------------------------------------------------------------------------------------------------------
def odd_texts():
    r = random.Random(2)
    low = [chr(c) for c in range(pretokens.EDGE)]
    return [t or "" for _, t in ODD] + ["".join(r.choice(low) for _ in range(50)) for _ in range(150)] + [
        "".join(r.choice(" \n\t\r\x1c\x85\xa0ab1'sS.") for _ in range(40)) for _ in range(200)] + [
        "<|endoftext|>x", "a <|startoftext|> b", "Σας ΣΑΣ", "İx", "漢字 test é ́a", "it's we'LL 'tis"]


def test_ids_and_counts_are_the_library_s():
    from tokenizers import Tokenizer
    w, b = tokenizer("word_bpe_49k.json"), tokenizer("byte_bpe_50k.json")
    words, bytes_ = Tokenizer.from_file(w), Tokenizer.from_file(b)
    for t in odd_texts():
        assert list(memoryview(packing.ids_of(t, w)).cast("I"))[:-1] == words.encode(t, add_special_tokens=False).ids
        assert token_count.count_one(t, b) == len(bytes_.encode(t, add_special_tokens=False).ids)


def test_frequent_chunks_outlive_a_full_memo():
    c = pretokens.Coder(tokenizer("word_bpe_49k.json"), True, memo=20_000)
    made = []
    for i in range(2000):
        got = c.looked_up(["often", f"rare{i}", "often"], lambda x: made.append(x) or x.upper())
        assert got == ["OFTEN", f"RARE{i}", "OFTEN"]
    assert made.count("often") == 1 and len(made) == 2001
    assert len(c.memo) + len(c.older) < 20_000 / 200


def test_token_counts(spark):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    got = token_count.token_counts(documents(spark, ODD), tokenizer("byte_bpe_50k.json")).collect()
    want = [(i, len((t or "").encode()), n := len(lib.encode(t or "", add_special_tokens=False).ids), n > 512) for i, t in ODD]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_differencing():
    r = random.Random(4)
    for _ in range(30):
        sizes = [r.randint(1, 4095) for _ in range(r.randint(1, 120))]
        w = packing.windows(sizes)
        assert sorted(i for x in w for i in x) == list(range(len(sizes)))
        assert all(sum(sizes[i] for i in x) <= 4096 for x in w)
    assert packing.windows([]) == [] and len(packing.windows([100] * 400)) == 10


def test_packing(spark):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    texts = [(i, prose(200, i)) for i in range(80)] + [x for x in ODD if x[0] is not None][:7]
    got = packing.pack(documents(spark, texts), tokenizer("word_bpe_49k.json")).collect()
    by_seq, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in got:
        by_seq[r.sequence_id].append(r)
        by_doc[r.doc_id].append(r)
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(numbers(r.ids)) == r.length
    for rows in by_seq.values():
        at = 0
        for r in sorted(rows, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 4096
    for i, t in texts:
        rows = sorted(by_doc[i], key=lambda r: r.start)
        assert sum((numbers(r.ids) for r in rows), []) == lib.encode(t or "", add_special_tokens=False).ids + [2]
        assert all(r.doc_tokens == sum(x.length for x in rows) for r in rows)
    assert packing.pack(documents(spark, []), tokenizer("word_bpe_49k.json"), with_ids=False).count() == 0


def numbers(ids):
    """Little-endian unsigned 32-bit numbers of a binary column."""
    return np.frombuffer(ids, "<u4").tolist()


def test_packed_ids_leave_the_pipeline(spark):
    """The last stage returns the sequences themselves; digests are those of the ids column."""
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(tokenizer("word_bpe_49k.json"))
    texts = [(i, prose(900 * i, i)) for i in range(8)] + [(9, None)]
    rows = corpus_pipeline.packing_stage(spark, documents(spark, texts), "").collect()
    made = {r.doc_id: r for r in packing.pieces(documents(spark, texts[:1]), tokenizer("word_bpe_49k.json")).collect()}
    assert numbers(made[0].ids) == [2] and "ids_crc32" not in made[0]
    for i, t in texts:
        mine = sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start)
        assert sum((numbers(r.ids) for r in mine), []) == lib.encode(t or "", add_special_tokens=False).ids + [2]
        assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(numbers(r.ids)) == r.length for r in mine)


# 7 ---------------------------------------------------------------------------------------------------------------------
PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(int(c) * 2, 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain_spans(t):
    out = []
    for k, (kind, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, t or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 14 <= len(d) <= 19 and luhn(d) or kind == "phone" and 10 <= len(d) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


PERSONAL = ["a@b.c_d@e.f x@y.zz+q@r.s", "1.2.3.4.5.6.7.8 256.1.1.1 0001.02.003.4 00000000000000000001.1.1.1 1.2.3",
            "9" * 50 + " 4111 1111 1111 1111 4111-1111-1111-1111 4111  1111 1111 1111", "+1 (017) 555-7713 +1+12345678901 +1 2. 3",
            "ü€😀 x@y.zz 😀 +49 30 1234567 ", None, "", "4111111111111111 4111111111111111", "a" * 3000 + "@", "x@" + "b." * 3000 + "c",
            "1 " * 5000, "1.1.1.1" * 300]


def test_personal_data(spark):
    df = documents(spark, [*enumerate(PERSONAL), (0, PERSONAL[0])])
    got = collections.defaultdict(list)
    for r in pii.report(df).collect():
        got[r.doc_id].append(r)
    assert len(got[0]) == 2
    for i, t in enumerate(PERSONAL):
        spans = plain_spans(t)
        text = ",".join(f"{list(PLAIN)[k]}:{a}:{b}" for a, k, b in spans)
        for r in got[i]:
            assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[1] == k for s in spans) for k in range(4)]
    assert pii.report(df.limit(0)).count() == 0


def plain_sanitised(t):
    out, at = "", 0
    for a, k, b in plain_spans(t):
        if a >= at:
            out += t[at:a] + f"[{list(PLAIN)[k].upper()}]"
        at = max(at, b)
    return out + t[at:]


def test_running_merges(spark):
    r = np.random.default_rng(5)
    arrays = [r.integers(0, 1000, n).tolist() for n in (0, 1, 63, 64, 65, 4095, 4097, 9000)]
    df = spark.createDataFrame([(v,) for v in arrays], "v array<int>")
    for levels in (1, 3):
        for got in df.select("v", pii.running(F.col("v"), pii._plus, levels).alias("s"), pii.running(F.col("v"), pii._later, levels).alias("m")).collect():
            assert got.s == [0, *np.cumsum(got.v).tolist()][:len(got.v)]
            assert got.m == [0, *np.maximum.accumulate(got.v).tolist()][:len(got.v)]


def test_texts_with_thousands_of_spans(spark):
    """Overlapping kinds, characters of two to four bytes, pieces crossed, long stretches without spans."""
    dense = " ".join(f"{'ü€😀'[i % 3]} u{i}.1.2.3.4@mail{i % 7}.example.com" for i in range(3000))
    texts = [*enumerate([*PERSONAL, dense, "€" * 5000 + dense[:3000] + " é" * 3000 + " x@y.zz", "1.1.1.1 " * 2000])]
    clean = {r.doc_id: r.text for r in pii.sanitise(documents(spark, texts)).collect()}
    assert all(clean[i] == (t and plain_sanitised(t)) for i, t in texts)


def test_disclosing_terms(spark):
    """A rare name that always stands with one address is a span; a common word is not."""
    texts = [(i, f"{prose(20, 900 + i)} zebulon writes from zeb@mail.example.com about {WORDS[i]} stones") for i in range(6)]
    texts += [(50 + i, "about writes stones from " + prose(30, 950 + i)) for i in range(60)]
    got = {r.doc_id: r for r in pii.report(documents(spark, texts)).collect()}
    for i, t in texts[:6]:
        at = t.index("zebulon")
        assert f"term:{at}:{at + 7}" in got[i].spans.split(",") and "email:" in got[i].spans
        assert not any(f"term:{t.index(w)}:" in got[i].spans for w in ("about", "writes", "stones"))
    assert all(got[i].spans == "" for i, _ in texts[6:])
    clean = {r.doc_id: r.text for r in pii.sanitise(documents(spark, texts)).collect()}
    assert all("[TERM] writes from [EMAIL] about" in clean[i] for i, _ in texts[:6]) and clean[50] == texts[6][1]


def test_disclosing_terms_over_whole_texts(spark):
    """One identical signature block, and the name again far from the address and beside another one."""
    far = " ".join(["quiet"] * 30)
    texts = [(i, f"Zebulon {i} {prose(20, 900 + i)} {far} kind regards zebulon zeb@mail.example.com" + (" and other@x.yz zebulon" * (i == 2)))
             for i in range(6)]
    texts += [(10, f"orlando@mail.example.com {far} orlando {far}")] * 2 + [(11, f"quentin {far} q@x.yz"), (12, f"quentin {far} q@x.yz")]
    texts += [(50 + i, f"kind regards {far} " + prose(30, 950 + i)) for i in range(60)]
    got = {r.doc_id: r.spans.split(",") for r in pii.report(documents(spark, texts)).collect()}
    for i, t in texts[:6]:
        want = {f"term:{m.start()}:{m.end()}" for m in re.finditer("zebulon", t.lower())}
        assert {s for s in got[i] if s.startswith("term")} >= want and len(want) == 2 + (i == 2)
        assert not any(f"term:{m.start()}:{m.end()}" in got[i] for m in re.finditer("kind|regards|quiet", t))
    assert all(s.startswith("email") for i in (10, 11, 12) for s in got[i])       # copies of one text are no support
    clean = {r.doc_id: r.text for r in pii.sanitise(documents(spark, texts)).collect()}
    assert not any("zebulon" in clean[i].lower() for i in range(6))


# 8 ---------------------------------------------------------------------------------------------------------------------
def test_vectors(spark):
    r = np.random.default_rng(6)
    rows = []
    for f in range(12):
        base = r.standard_normal(24)
        for _ in range(15):
            v = base + r.standard_normal(24) * np.linalg.norm(base) * 0.03
            rows.append((len(rows), [float(x) for x in v], f % 3))
    rows += [(500 + i, [float(x) for x in r.standard_normal(24)], i % 3) for i in range(150)]
    rows += [(700, rows[0][1], 0), (701, [2 * x for x in rows[0][1]], 0), (702, rows[0][1], 1), (703, rows[0][1], None), (704, None, 0),
             (705, [0.0] * 24, 0), (706, [float("nan")] * 24, 0), (707, [None, 1.0], 0), (708, [], 0), (709, [1.0], 0), (710, [3.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("vid", F.lit("x"))
    comp, links = {i: i for i, _, _ in rows}, collections.Counter()
    sound = [(i, np.array(v), c) for i, v, c in rows if v and c is not None and None not in v and np.isfinite(v).all() and any(v)]
    for a in range(len(sound)):
        for b in range(a):
            (i, x, c), (j, y, d) = sound[a], sound[b]
            if c == d and len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.98:
                links[i] += 1
                links[j] += 1
                low, high = sorted((comp[i], comp[j]))
                comp = {k: low if v == high else v for k, v in comp.items()}
    for params in ({}, {"block": 4}, {"sigmas": None}):
        got = {x.vec_id: (x.n_links, x.component_id, x.kept) for x in capfilter.near_duplicates(df, **params).collect()}
        assert got == {i: (links[i], comp[i], comp[i] == i) for i, _, _ in rows}
    assert sum(links.values()) > 100 and capfilter.near_duplicates(df.limit(0)).count() == 0


def test_vectors_with_null_and_repeated_ids(spark):
    """A null id, alone or in a group, and one id with two vectors whose links stay apart."""
    r = np.random.default_rng(7)
    a, b, c, d = (r.standard_normal(24) for _ in range(4))
    near = lambda v: [float(x) for x in v + r.standard_normal(24) * 0.01]
    rows = [(None, near(a), 0), (5, near(b), 0), (5, near(c), 0), (6, near(b), 0), (7, near(b), 0), (9, near(c), 0),
            (None, near(d), 0), (8, near(d), 0), (4, near(a + b), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = collections.Counter((x.vec_id, x.n_links, x.component_id, x.kept) for x in capfilter.near_duplicates(df).collect())
    assert got == collections.Counter([(None, 0, None, True), (5, 2, 5, True), (5, 1, 5, True), (6, 2, 5, False), (7, 2, 5, False),
                                       (9, 1, 5, False), (None, 1, 8, False), (8, 1, 8, True), (4, 0, 4, True)])


# 10 --------------------------------------------------------------------------------------------------------------------
def junk(seed):
    r = random.Random(seed)
    w = prose(r.randint(30, 200), seed).split()
    return " ".join(x + r.choice(["###", "$$$", "&&&"]) for x in w) if seed % 2 else " | ".join(w)


def test_quality(spark):
    texts = [(i, junk(i) if i % 4 == 0 else ". ".join(prose(30, 40 * i + k) for k in range(4))) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 != 0), 0) for i in range(400)] + [(None, 1, 0), (7, None, 0)], "doc_id long, quality int, toxic int")
    df = documents(spark, texts + ODD)
    model = quality.fit(df, labels)
    got = quality.scored(df, model).collect()
    assert len(got) == len(texts) + len(ODD) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    out = [r for r in got if r.doc_id is not None and r.doc_id < 400 and r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert len(out) > 40 and np.mean([r.predicted == (r.doc_id % 4 != 0) for r in out]) > 0.97
    assert "Python" not in quality.scored(df, model)._jdf.queryExecution().executedPlan().toString()
    none = quality.fit(df, labels.limit(0))
    assert {r.score for r in quality.scored(df, none).collect()} == {0.5}


def test_rules_follow_paths():
    text = "Model\n  Tree 0 (weight 1.0):\n    If (feature 0 <= 1.5)\n     If (feature 1 > 2.0)\n      Predict: 1.0\n     Else (feature 1 <= 2.0)\n      Predict: 0.0\n" \
           "    Else (feature 0 > 1.5)\n     Predict: 1.0\n"
    got = {r.terms for r in quality.paths(text.replace("Else (feature 1 <= 2.0)", "Else (feature 1 <= 2.0)"), ["a", "b"])}
    assert (("a", True, 1.5),) in got and (("a", True, 1.5), ("b", False, 2.0)) in got and (("a", False, 1.5),) in got


# native operators and the pipeline -------------------------------------------------------------------------------------
def test_native_plans(spark):
    df = documents(spark, ODD)
    plans = [sharding.shard(df, "doc_id", ["a", "b"], 101),
             decontaminate.overlaps(df, spark.createDataFrame([(1, prose(20, 1))], "item_id long, text string")), pii.report(df)]
    for p in plans:
        assert not re.search("Python|Pandas|Arrow", p._jdf.queryExecution().executedPlan().toString())


def test_pipeline(spark, tmp_path):
    bench = prose(20, 70)
    base = [". ".join(prose(25, 60 * i + k) for k in range(4)) for i in range(60)]
    texts = list(enumerate(base)) + [(100 + i, edited(base[i], 1, i)) for i in range(5)] + [(200, base[50] + " " + bench)]
    texts += [(300 + i, junk(2 * i)) for i in range(30)] + [(400, base[7] + " write me@mail.example.com"), (401, None), (402, ""), (403, base[9])]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in texts]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(i, int(i < 300), 0) for i, _ in texts], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs, kept = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept.append({r.doc_id: r.text for r in docs.collect()})
    assert not any(300 <= i < 400 for i in kept[0]) and set(range(60)) <= set(kept[0])
    groups = {i: c for i, _, c in brute_groups(sorted(kept[0].items()), 5, 80, 100)}
    assert set(kept[1]) == {i for i, c in groups.items() if i == c} and 403 not in kept[1]
    assert set(kept[2]) == set(kept[1]) - {200}
    assert kept[3] == {i: re.sub(PLAIN["email"], "[EMAIL]", t) if t else t for i, t in kept[2].items()}
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in packed} == set(kept[3])


def test_columns_named_like_internal_ones(spark):
    """Stages keep every column, whatever its name."""
    clash = ["__key", "__spans", "__here", "key", "spans", "here", "_KEY", "Spans"]
    base = documents(spark, [(1, "write to a.b@c.org now"), (2, prose(40, 3)), (2, prose(40, 3)), (3, prose(40, 5)), (4, None)])
    base = base.drop(*clash)
    docs = base.withColumns({c: F.lit(c + "!") for c in clash if c not in ("_KEY", "Spans")})
    bench = spark.createDataFrame([(1, prose(40, 5))], "item_id long, text string")
    held = {c: c + "!" for c in docs.columns if c in clash}
    got = pii.sanitise(docs).collect()
    assert len(got) == 5 and {r.text for r in got if r.doc_id == 1} == {"write to [EMAIL] now"}
    kept = decontaminate.clean(docs, bench).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2, 2, 4]
    once = corpus_pipeline.dedup_stage(spark, docs, "").collect()
    assert sorted(r.doc_id for r in once) == [1, 2, 3, 4]
    assert all(r[c] == v for rows in (got, kept, once) for r in rows for c, v in held.items())
