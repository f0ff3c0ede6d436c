"""The operators on single texts against the tokenizers' libraries and plain Python."""

import base64
import hashlib
import html
import re
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken

import check
from tallybook.llm import byte_bpe, chat_format, decontaminate, html_extract, language_id, quality, queries, token_counts
from tallybook.llm.oracles import ORACLES
from tallybook.llm.common import blocks, shingles, span_hashes, text_buffers
from tests.llm import cases

MODEL = public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
ODD = [
    "", " ", "  a  b ", "a" * 3000, " " * 900 + "x", "x" + " " * 900, "\x1c\x1d x\x85y\u00a0z\u2003 ", "日本語 \U0001d11e👍🏽 \r\n\t x",
    "'s 'll I'm '' ####====----", "</s> <unk> <|endoftext|> ▁ ▁▁a", "ab " * 4000, "é" * 5000, "\u2581\u2581 x \u2581", "a\nb\n\n\nc" * 300,
]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_token_counts(spark):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [*cases.documents(), *enumerate(ODD, 500), (600, cases.prose(1, 30_000))]
    found = token_counts.count_documents(cases.frame(spark, rows), MODEL).collect()
    wanted = [(i, len((t or "").encode()), len(model.encode(t or ""))) for i, t in rows]
    assert sorted(map(str, (tuple(r)[:3] for r in found))) == sorted(map(str, wanted))
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in found) and any(r["over_limit"] for r in found)


@pytest.mark.parametrize("chunk", [(20, 4), (64, 8), (700, 64)])
def test_chunks_count_as_the_whole(chunk):
    model = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for text in [*ODD, *(t or "" for _, t in cases.documents())]:
        assert token_counts.count_tokens(MODEL, text, *chunk) == len(model.encode(text)), text[:40]


def test_byte_bpe_equals_the_library(spark, tiktoken_encoding):
    rows = [*cases.documents(), *enumerate(ODD, 500)]
    encoded = byte_bpe.encode(cases.frame(spark, rows), RANKS, public_tokenizers.PATTERN)
    found = byte_bpe.decode(encoded, RANKS).collect()
    at_once = byte_bpe.encode(cases.frame(spark, rows), RANKS, public_tokenizers.PATTERN, decoded=True).collect()
    assert sorted(map(str, map(tuple, at_once))) == sorted(map(str, map(tuple, found)))
    wanted = [(i, np.array(tiktoken_encoding.encode_ordinary(t or ""), "<u4").tobytes(), (t or "").encode()) for i, t in rows]
    assert sorted(str((r[0], bytes(r[1]), bytes(r[2]))) for r in found) == sorted(map(str, wanted))


def test_replay_takes_a_lower_pair_that_comes_up(tmp_path):
    tokens = [bytes([b]) for b in range(256)] + [b"xyab", b"ab", b"xy"]  # xyab has the lowest rank of the three
    path = tmp_path / "ranks"
    path.write_text("".join(f"{base64.b64encode(t).decode()} {i}\n" for i, t in enumerate(tokens)))
    ranks = byte_bpe.Ranks(str(path))
    words = [b"xyabxyab", b"abab", b"xyxyab", b"aab"]
    ids, counts = ranks.replay(words)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    assert [p.tolist() for p in parts] == [ranks.one_by_one(w) for w in words]


def test_chats_are_read_back(spark):
    odd = ["", "</s>", "\\", "a\\", "\\</s>", "\\\\[INST]", " [NEXT] ", "[ROLE] x [SAYS] y [END]", " [/INST]", "<s>\n", "été 日本"]
    rows = [(c, k, r, t) for c, r in enumerate(["user", "assistant", "system", "[INST]", " [SAYS] "]) for k, t in enumerate(odd)]
    rows += [(50, k, ["user", "assistant"][k // 2 % 2], f"turn {k}") for k in range(300)]
    rows += [(60, 1, "user", None), (60, None, None, "first"), (60, 1, "user", "tie"), (60, 1, "user", "tie"), (None, 1, "tool", "x")]
    turns = spark.createDataFrame([(*r, "z", 1) for r in rows], "conv_id long, turn long, role string, text string, said string, b int")
    found = {r["conv_id"]: r for r in chat_format.digests(chat_format.format_chats(turns)).collect()}
    for conv in {r[0] for r in rows}:
        own = [(t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv]
        said = sorted(own)
        loss = "".join(x for _, _, r, x in said if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in said).encode()).hexdigest()
        got = found[conv]
        assert (got["n_turns"], got["turns_sha256"]) == (len(said), digest), conv
        assert (got["loss_chars"], got["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    text = chat_format.format_chats(turns.where("conv_id = 50")).first()
    assert text["formatted"].startswith("[INST] turn 0 [NEXT] turn 1 [/INST][OUT] turn 2 [NEXT] turn 3 </s>")
    assert "".join(p["text"] for p in text["parts"]) == text["formatted"]
    assert chat_format.format_chats(turns.limit(0)).count() == 0


def plain_quality(text):
    text = text or ""
    words = cases.WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    twice = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if cases.WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(twice)


def test_quality(spark):
    good = cases.prose(50, 60) + ".\n" + cases.prose(51, 40) + "."
    more = [
        (700, good), (701, good + "\nLicensed under the X License.\nHome | About | Contact | More"),
        (702, "\n".join("home | about | " + cases.prose(k, 4) for k in range(30))),
        (703, " ".join(w.upper() + "!!" for w in cases.prose(60, 90).split())),
        (704, " ".join(w + "%%%" for w in cases.prose(61, 90).split())), (705, "same words " * 40),
    ]
    rows = [*cases.documents(), *more]
    found = quality.assess(cases.frame(spark, rows)).collect()
    base = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = sorted(str((r["doc_id"], *(r[c] for c in base))) for r in found)
    assert got == sorted(str((i, *plain_quality(t))) for i, t in rows)
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    kept = {r["doc_id"]: r["kept"] for r in found}
    assert [kept[k] for k in range(700, 706)] == [True, True, False, False, False, False]
    passed = quality.keep(cases.frame(spark, rows))
    assert passed.columns == cases.frame(spark).columns
    assert sorted(str(r["doc_id"]) for r in passed.collect()) == sorted(str(r["doc_id"]) for r in found if r["kept"])
    assert quality.assess(cases.frame(spark, []).limit(0)).count() == 0


def test_failed_lines_are_cut(spark):
    good, more = cases.prose(50, 60) + ".", cases.prose(51, 40) + " é日本."
    away = ["Licensed under the X License.", "Home | About | Contact | More", "All rights reserved."]
    rows = [
        (1, good), (2, f"{good}\n{away[0]}\n{more}"), (3, f"{away[1]}\n\n \n{good}\n{away[1]}\n\n"), (4, None), (5, ""),
        (6, f"{away[2]}\n{good}\r\n{more}\n{away[0]}\n{away[2]}"), (7, away[0]), (8, f"\n{good}\n"), (None, f"{good}\n{away[2]}"),
    ]
    wanted = [(1, good), (2, f"{good}\n{more}"), (3, f"\n \n{good}\n\n"), (6, f"{good}\r\n{more}"), (8, f"\n{good}\n"), (None, good)]
    table = cases.frame(spark, rows + cases.documents())
    found = quality.cut_failed_lines(table)
    assert found.columns == table.columns
    got = [(r["doc_id"], r["text"]) for r in found.collect()]
    assert not [x for x in wanted if x not in got]
    told = quality.assess(table).where("kept").collect()
    assert sorted(str(i) for i, _ in got) == sorted(str(r["doc_id"]) for r in told)
    left = sorted((str(i), len(cases.WORD.findall(t))) for i, t in got)
    assert left == sorted((str(r["doc_id"]), r["n_words_left"]) for r in told)
    assert quality.cut_failed_lines(table.limit(0)).count() == 0


def test_boilerplate_phrases_have_word_edges_and_a_share(spark):
    prose = cases.prose(70, 60) + " {} " + cases.prose(71, 60) + "."
    lines = cases.prose(72, 80) + ".\n{}"
    clean = [prose.format(f"in her {p.strip()} in May") for p in quality.BOILERPLATE]
    inner = ["The blog in her catalog in May.", "A design in blue.", "Subscribers came.", "Typescript and JavaScripts."]
    edged = ["\u201cLog in\u201d here.", "Please sign in.", "Copyright \u00a9 us.", "(All Rights Reserved.)", "caf\u00e9 log in."]
    glued = ["It \u00e9log in may.", "It is log in\u00e9dit."]
    long = " ".join(["Terms of use and privacy policy as told."] * 6)
    rows = [*enumerate(clean), *enumerate((lines.format(x) for x in [*inner, *glued]), 100)]
    rows += enumerate((lines.format(x) for x in [*edged, long]), 200)
    for r in quality.assess(cases.frame(spark, rows)).collect():
        assert (r["kept"] or r["doc_id"] == 205), r  # the long line of phrases repeats itself
        assert r["n_lines_removed"] == (r["doc_id"] >= 200), r
    one_hit = cases.prose(73, 40) + " sign in sign in sign in log inlog in " + cases.prose(74, 20) + "."
    rows += [(300, one_hit), (301, "Log in sign in."), (302, None), (303, cases.prose(75, 70) + " " + one_hit), *cases.documents()]
    equals_sql(spark, rows)
    own = quality.assess(cases.frame(spark, [(1, lines.format("Buy now, friends."))]), ["buy now"]).first()
    assert own["n_lines_removed"] == 1


def equals_sql(spark, rows):
    duck = duckdb.connect()
    duck.register("documents", pa.table({"doc_id": pa.array([i for i, _ in rows], pa.int64()), "text": [t for _, t in rows]}))
    result = duck.execute(ORACLES["op9_quality_rules"])
    wanted = check.sorted_rows([c[0] for c in result.description], result.fetchall())
    df = quality.assess(cases.frame(spark, rows))
    assert check.sorted_rows(df.columns, [tuple(r) for r in df.collect()]) == wanted


def test_languages(spark):
    words = {"xx": "abc bcd cab", "yy": "mno nop omn", "zz": "ñéü üñé éüñ"}
    rows = [(k, f"{w} {k} " * 5, lang) for k in range(60) for lang, w in [list(words.items())[k % 3]]]
    rows += [(900, None, "xx"), (901, "123 !?", "yy"), (902, "", "zz"), (903, "ABC Bcd", None), (None, "mno nop", "xx"), (904, "a", "xx")]
    table = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, lang string, score int")
    found = {r["doc_id"]: r for r in language_id.held_out_languages(table).collect()}
    for i, text, lang in rows[:60]:
        assert found[i]["lang_pred"] == lang and 0 < found[i]["score"] <= 1
        assert found[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1)
    assert [found[k]["lang_pred"] for k in (900, 901, 902, 903)] == ["und", "und", "und", "xx"]
    assert found[900]["score"] == 0 and found[None]["lang_pred"] == "yy" and found[None]["held_out"] is False
    nothing = language_id.held_out_languages(table.limit(0))
    assert nothing.count() == 0
    assert {r["lang_pred"] for r in language_id.identify(table, {}).collect()} == {"und"}


def bundled(text):
    """The text's vector, letter by letter."""
    slots, plain = language_id.letter_slots(), language_id.letter_vectors()[0].astype(int)
    row = [0]
    for letter in text or "":
        slot = int(slots[ord(letter)])
        if slot or row[-1]:
            row.append(slot)
    row += [0] * (row[-1] != 0)
    out = np.zeros(language_id.DIMENSIONS)
    for a, b, c in zip(row, row[1:], row[2:]):
        out += np.roll(plain[a], 2) * np.roll(plain[b], 1) * plain[c]
    return out


@pytest.mark.parametrize("slice_", [language_id.SLICE, 7])
def test_languages_by_plain_bundling(spark, monkeypatch, slice_):
    monkeypatch.setattr(language_id, "SLICE", slice_)
    texts = ["The cat sat.", "Le chat, 2 chats!", "Der Hund ß", "日本語 です", "a", "Straße über été", "the the the", "12", "", None, " x  y "]
    rows = [(k, t, ["en", "fr", "de", None][k % 4]) for k, t in enumerate(texts * 3)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sums: dict[str, np.ndarray] = {}
    for _, text, lang in rows:
        if lang and text is not None and bundled(text).any():
            sums[lang] = sums.get(lang, 0) + bundled(text)
    vectors = language_id.learn(table)
    assert set(vectors) == set(sums) and all((vectors[k] == sums[k]).all() for k in sums)
    for row in language_id.identify(table, vectors).collect():
        own = bundled(rows[row["doc_id"]][1])
        cosines = {k: own @ v / np.linalg.norm(own) / np.linalg.norm(v) for k, v in sums.items()} if own.any() else {}
        best = max(cosines.values(), default=0)
        assert row["score"] == pytest.approx(max(best, 0), abs=1e-5)
        assert (row["lang_pred"] == "und") == (not cosines) and cosines.get(row["lang_pred"], 0) == pytest.approx(best, abs=1e-5)


def test_held_out_accuracy(spark):
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    truth = {r["doc_id"]: r["lang"] for r in documents.select("doc_id", "lang").collect()}
    held = [r for r in queries.language_of(spark, "/root/testdata/sf0.001").collect() if r["held_out"] and truth[r["doc_id"]]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in held) >= 0.95 * len(held) > 0


def page(k, more="", body=None):
    body = body or f"<p>First {k} &amp; <b>bold</b>\n text<p>Second&nbsp;{k} <a href='x'>link</a>.</p>"
    return (
        f"<!DOCTYPE html><html><head><title>T{k}</title><script>var t='</p>';</script></head><body><nav><ul><li><a>m{k}</a>"
        f"<li>n</ul></nav><!-- x --><header>Site</header><div class='cookie-notice'>We use</div><div class=\"ad\">Buy {k}</div>"
        f"<article><h1>Title {k}</h1>{body}{more}<aside>See also</aside></article>"
        f"<form>Mail</form><section id='comments'><p>Reader {k}</p></section><footer>&copy; {k}</footer>"
    )


def test_pages(spark):
    rows = [(k, "http://a.example/x" if k % 2 else "https://A.example:80/y", page(k, "<h4>Read all our news</h4>" * (k % 3))) for k in range(12)]
    rows += [(50, "http://b.example", page(50)), (51, None, page(51)), (52, "http://[odd", "plain words"), (53, "http://b.example", None)]
    rows += [(54, "http://c.example", "<div><ul><li><a>m</a></ul></div><div class=c1><p>one<p>two</div>"), (55, "", "<p>cut <b"), (50, "http://b.example", page(50))]
    table = spark.createDataFrame([(*r, "r", "h") for r in rows], "page_id long, url string, html string, rule string, host string")
    found = html_extract.extract_pages(table, html_extract.infer_rules(table)).collect()
    text = {r["page_id"]: r["text"] for r in found}
    assert len(found) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in found)
    for k in [*range(12), 50, 51]:
        assert text[k].startswith(f"Title {k} First {k} & bold text Second {k} link."), text[k]
        assert not re.search("Buy|Reader|Mail|See also|We use|Site|news", text[k]), text[k]
    assert (text[52], text[53], text[54], text[55]) == ("plain words", "", "one two", "cut")
    nothing = table.limit(0)
    assert html_extract.extract_pages(nothing, html_extract.infer_rules(nothing)).count() == 0


LONG = "Some words of the article that go on for a while, and then a few more of them."


@pytest.mark.parametrize(
    ("body", "wanted"),
    [
        ("<div class='site-content has-sidebar'><article><p>{0}</p></article></div>", "{0}"),
        ("<article class='post no-comments'><p>{0}</p></article>", "{0}"),
        ("<article class='post category-search'><p>{0}</p><div class='related'>R</div></article>", "{0}"),
        ("".join(f"<div class='{chr(97 + k // 26)}{chr(97 + k % 26)}x'>{{0}}</div>" for k in range(400)), " ".join(["{0}"] * 400)),
        ("<section><p>{0} 1</p></section><section><p>{0} 2</p></section><section><p>{0} 3</p></section>", "{0} 1 {0} 2 {0} 3"),
        ("<article><header><h1>Title</h1></header><p>{0}</p><footer>F</footer></article>", "Title {0}"),
        ("<div class='post'><h1>Title</h1><div class='entry'><p>{0}</p></div></div>", "Title {0}"),
        ("<form id='f'><article><p>{0}</p></article></form>", "{0}"),
        ("<div class='sidebar-layout'><article><p>{0}</p></article></div><p>Short.</p>", "{0}"),
        ("<article><p>{0}</p></article><ol class='comment-list'><li><article class='comment'><p>{0}{0}</p></article></ol>", "{0}"),
        ("<div class='content'><p>{0}</p></div><div id='comments'><article><p>Me too</p></article></div>", "{0}"),
        ("<div class='search-page'><p>{0}</p></div>", "{0}"),
        ("<div>{0}<br>{0}</div>", "{0} {0}"),
        ("<nav>{0}</nav><aside><p>{0}</p></aside>", ""),
    ],
)
def test_shapes_of_pages(spark, body, wanted):
    """Alone, and as one of a host's pages that agree in their title and differ in their text."""
    nav = "<header><h1>Site</h1></header><nav><ul><li><a>m</a></ul></nav><div class='ad-slot'><p>Buy</p></div>"
    build = lambda k: f"<html><body>{nav}{body.format(LONG + f' {k}')}<footer>end</footer></body></html>"
    for host in ("http://x.example/{0}", "http://{0}.example"):
        rows = [(k, host.format(k), build(k)) for k in range(7)]
        table = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(2)
        found = html_extract.extract_pages(table, html_extract.infer_rules(table)).collect()
        assert {r["page_id"]: r["text"] for r in found} == {k: wanted.format(LONG + f" {k}") for k in range(7)}


def test_title_that_recurs_stays(spark):
    rows = [(k, "http://x.example", f"<article><h1>Weekly report</h1><p>{LONG} {k}</p><h4>Read on</h4></article>") for k in range(8)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = html_extract.extract_pages(table, html_extract.infer_rules(table)).collect()
    assert sorted(r["text"] for r in found) == [f"Weekly report {LONG} {k}" for k in range(8)]


def test_pages_of_the_small_table(spark):
    """Against the article element cut out by hand, tag by tag."""
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    wanted = {}
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", r["html"] or "", re.S)
        pieces = re.split(r"</?(?:h1|p|br)\b[^>]*>", article.group(1) if article else "")
        texts = [" ".join(html.unescape(re.sub(r"</?[a-z][^>]*>", "", x)).split()) for x in pieces]
        wanted[r["page_id"]] = " ".join(x for x in texts if x)
    found = {r["page_id"]: r["text"] for r in queries.page_texts(spark, "/root/testdata/sf0.001").collect()}
    assert found == wanted and all(found.values())


def test_wrapper_is_union_free():
    tree = lambda x: html_extract.expression(html_extract.parse(x))
    one = tree("<ul><li>a</li><li>b</li></ul><p>same</p>")
    two = tree("<ul><li>c</li></ul><h2>x</h2><p>same</p>")
    both = html_extract.merged(one, two)[html_extract.INSIDE]
    assert [(n[0], n[1], n[2]) for n in both] == [("ul", False, False), ("h2", False, True), ("p", False, False)]
    assert both[0][6][0][:3] == ["li", True, False] and both[2][6][0][5] == "same"


ITEM = "Anna Smith bought 12 apples for 3 dollars and then Anna gave 12 of the many apples to Bob before the long walk home."


def test_decontamination(spark):
    around = lambda x: cases.prose(1, 30) + ". " + x + " " + cases.prose(2, 30)
    again = ITEM.replace("12", "45").replace("3 d", "7 d").replace("Anna", "Clara").replace("Bob", "Dan").replace("Smith", "Jones")
    crossed = again.replace("gave 45", "gave 99")  # the same value of the item stands for two
    rows = [
        (1, around(ITEM)), (2, around(ITEM.lower())), (3, around(again)), (4, around(crossed)), (5, cases.prose(3, 200)), (6, None),
        (7, ""), (8, " ".join(ITEM.split()[:9])), (None, ITEM), (9, ITEM), (9, ITEM), (10, around("Étude brève du soir")), (11, around(ITEM) * 30),
    ]
    bench = [(100, ITEM), (101, None), (102, "three words only"), (103, "étude brève du soir"), (None, ITEM), (104, cases.prose(4, 40))]
    items = spark.createDataFrame([(*b, 1) for b in bench], "item_id long, text string, doc_id int")
    found = {(r["doc_id"], r["item_id"]): r["literal"] for r in decontaminate.contaminated(cases.frame(spark, rows), items).collect()}
    assert {k: v for k, v in found.items() if k[0] != 4} == {
        (1, 100): True, (2, 100): True, (3, 100): False, (9, 100): True, (10, 103): True, (11, 100): True,
    }
    assert (4, 100) not in found
    kept = decontaminate.clean(cases.frame(spark, rows), items)
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["4", "5", "6", "7", "8"])
    assert kept.columns == cases.frame(spark).columns
    assert decontaminate.contaminated(cases.frame(spark, rows), items.limit(0)).count() == 0
    assert decontaminate.contaminated(cases.frame(spark, []).limit(0), items).count() == 0


def test_the_filter_holds_every_key_and_few_others(spark):
    own = np.random.default_rng(4)
    keys = own.integers(-(1 << 63), 1 << 63, 90_000)
    items = spark.createDataFrame([(int(k), 8) for k in keys[:30_000]], "key long, width long")
    allowed, widths = decontaminate._filter(items)
    held = decontaminate._held(allowed, keys.view(np.uint64))
    assert widths == [8] and held[:30_000].all() and held[30_000:].mean() < 0.02 and len(allowed) == 1 << 17


def test_rows_without_id_are_judged_by_their_text(spark):
    around = lambda x: cases.prose(1, 30) + ". " + x + " " + cases.prose(2, 30)
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    rows = [(None, around(ITEM)), (None, cases.prose(5, 60)), (7, around(ITEM)), (7, cases.prose(6, 60)), (None, None), (8, "")]
    kept = decontaminate.clean(cases.frame(spark, rows), items).select("doc_id", "text").collect()
    assert sorted(map(str, map(tuple, kept))) == sorted(str(r) for r in rows if ITEM not in (r[1] or ""))


def test_questions_with_opening_names_and_dense_numbers(spark):
    around = lambda x: cases.prose(1, 30) + ". " + x + " " + cases.prose(2, 30)
    bench = [(1, "Anna has 7 red apples and buys 9 more today."), (2, "What is 12 + 7 + 3 + 9"), (3, "Add 5 apples, 6 pears, 7 plums and 8 figs")]
    rows = [
        (1, around("Tom has 5 red apples and buys 3 more today.")), (2, around("What is 4 + 8 + 2 + 1?")),
        (3, around("Add 1 apples, 2 pears, 3 plums and 4 figs.")), (4, around("What was 4 + 8 + 2 + 1?")),
        (5, around("Tom has 5 red apples and sells 3 more today.")), (6, around("What is 4 + 8")),
    ]
    items = spark.createDataFrame(bench, "item_id long, text string")
    found = decontaminate.contaminated(cases.frame(spark, rows), items).collect()
    assert sorted((r["doc_id"], r["item_id"], r["literal"]) for r in found) == [(k, k, False) for k in (1, 2, 3)]


def test_literal_leaks_of_the_small_tables(spark):
    """Brute force over whole tables: the items that a text holds word for word."""
    sf = "/root/testdata/sf0.001"
    token = lambda t: re.findall(r"[^\W_]+", t.lower())
    docs = [(r["doc_id"], token(r["text"] or "")) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    bench = [(r["item_id"], token(r["text"])) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    wanted = {(i, b) for i, t in docs for b, x in bench if f" {' '.join(x)} " in f" {' '.join(t)} "}
    found = {(r["doc_id"], r["item_id"]) for r in queries.decontamination(spark, sf).collect()}
    assert found == wanted and wanted


def test_spans_hash_alike_wherever_they_stand():
    texts = pa.array(["one two three four five", None, "", "x one two three four five y", "a b"])
    data, at = text_buffers(texts)
    assert span_hashes(data, np.array([0]), np.array([3])) == span_hashes(data, at[3:4] + 2, at[3:4] + 5)
    block = next(blocks(texts))
    tokens, owner = shingles(block.data, block.at, 5, whole=True)
    assert owner.tolist() == [0, 3, 3, 3, 4] and set(tokens[owner == 0]) < set(tokens[owner == 3])
    assert [(b.first, b.last) for b in blocks(texts, 10)] == [(0, 1), (1, 3), (3, 4), (4, 5)]
