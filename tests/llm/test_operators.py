"""Each operator on edge rows, empty tables, and against a plain model or a round trip."""

import datetime
import gzip
import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

from rankloom.llm import (
    chat, components, decontaminate, html_text, language_id, mixing, near_dup, pii, quality, token_counts, warc, wordhash
)


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text))


def test_word_hashes_tell_words_and_texts_apart():
    texts = ["Ab c", None, "", "ab", "c\tAB  é", "x" * 5000 + " ab"]
    groups = list(wordhash.word_groups(pa.array(texts), wordhash.BY_SPACE, 10))
    hashes = {first: (words, bounds) for first, words, bounds in groups}
    flat = [list(words[a:b]) for words, bounds in hashes.values() for a, b in zip(bounds[:-1], bounds[1:])]
    assert [len(words) for words in flat] == [2, 0, 0, 1, 3, 2]
    assert flat[0][0] == flat[3][0] == flat[4][1] == flat[5][1] and flat[0][1] == flat[4][0]


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = " ".join(f"w{i}" for i in range(3000)) + " " + "y" * 900
    whole = next(wordhash.word_groups(pa.array([text]), wordhash.BY_SPACE, 1 << 20))[1]
    monkeypatch.setattr(wordhash, "SLICE", 64)
    pieces = next(wordhash.word_groups(pa.array([text]), wordhash.BY_SPACE, 1 << 20))[1]
    assert (whole == pieces).all() and len(set(whole)) == 3001


def test_components_of_paths_and_rings(spark):
    links = [(i, i + 1) for i in range(40)] + [(50, 51), (52, 51), (60, 60)]
    found = components.connected_components(spark.createDataFrame(links, "a long, b long"))
    got = {r.node: r.component for r in found.collect()}
    assert all(got[i] == 0 for i in range(41)) and {got[i] for i in (50, 51, 52)} == {50}
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_equal_a_plain_model(spark, docs, edge_rows):
    random.seed(5)
    base = [f"w{random.randrange(400)}" for _ in range(120)]
    texts = [" ".join(base), " ".join(base).upper()]
    for edits in (1, 1, 2, 3, 3, 4, 5, 6, 8):
        words = list(base)
        for _ in range(edits):
            words[random.randrange(len(words))] = f"new{random.randrange(10**6)}"
        texts.append(" ".join(words))
    texts += ["one two three", "One two  three", "", "other words that stand for themselves only here"]
    sets = [{tuple(w[k : k + 5]) for k in range(max(len(w) - 4, 1))} if w else set() for w in map(spaced, texts)]
    parent = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                a, b = (next(p for p in range(len(parent)) if parent[x] == p) for x in (i, j))
                parent = [min(a, b) if p in (a, b) else p for p in parent]
    got = {r.doc_id: r for r in near_dup.near_duplicates(docs(*texts)).collect()}
    assert [got[i].component_id for i in range(len(texts))] == parent
    assert [got[i].n_shingles for i in range(len(texts))] == [len(s) for s in sets]
    kept = near_dup.keep_one(docs(*texts))
    assert kept.columns == docs(*texts).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(parent))
    edge = near_dup.near_duplicates(edge_rows).collect()
    assert len(edge) == 8 and {r.component_id for r in edge if r.n_shingles == 1 and r.doc_id != 5} == {4}
    assert near_dup.keep_one(edge_rows).where("text = 'one two'").count() == 1
    assert near_dup.near_duplicates(edge_rows.limit(0)).count() == 0


def test_decontamination_equals_a_plain_model(spark, docs, edge_rows, monkeypatch):
    random.seed(2)
    word = lambda: f"w{random.randrange(30)}"
    items = [(i, " ".join(word() for _ in range(n))) for i, n in enumerate((5, 13, 20, 40, 1, 0))] + [(7, None), (None, "w1")]
    items.append((9, items[3][1].upper().replace(" ", ", ")))
    texts = [" ".join([*(word() for _ in range(50)), items[k][1], *(word() for _ in range(9))]) for k in (0, 1, 2, 3, 5)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    parts = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower())
    windows = defaultdict(set)
    for item, text in items:
        w = parts(text)
        for k in range(len(w) - min(13, len(w)) + 1) if w and item is not None else ():
            windows[tuple(w[k : k + 13])].add(str(item))

    def judge(text):
        w, hit, found = parts(text), set(), set()
        for window, ids in windows.items():
            for k in range(len(w) - len(window) + 1):
                if tuple(w[k : k + len(window)]) == window:
                    hit |= set(range(k, k + len(window)))
                    found |= ids
        return len(w), len(hit), ",".join(sorted(found))

    for block_words in (decontaminate.BLOCK_WORDS, 10):
        monkeypatch.setattr(decontaminate.benchmark_blocks, "__defaults__", (13, block_words))
        got = decontaminate.verdicts(docs(*texts), bench).collect()
        assert [(r.n_words, r.n_hit, ",".join(r["items"])) for r in sorted(got)] == [judge(t) for t in texts]
    clean = decontaminate.remove_contaminated(docs(*texts, "zz yy", None), bench)
    assert sorted(r.doc_id for r in clean.collect()) == [
        i for i, t in enumerate([*texts, "zz yy", None]) if not (judge(t)[1] and 20 * judge(t)[1] >= judge(t)[0])
    ]
    longest = decontaminate.longest_matches(docs(texts[3]), bench).where("item_id = 3").agg(F.max("n_words")).first()[0]
    assert longest == 40
    assert decontaminate.verdicts(edge_rows, bench).count() == 8
    assert decontaminate.verdicts(docs(*texts), bench.limit(0)).agg(F.sum("n_hit")).first()[0] == 0


def test_tokens_equal_the_library_at_every_prefix(docs, edge_rows):
    path = public_tokenizers.path(token_counts.MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = ["  two  spaces ", " ", "▁x▁▁", "日本 🙂 é́", "aaaaaaa aaaa    aaa", "<s> hi </s><unk>", "\t\n\n  \r q", "a b c"]
    got = {r.doc_id: r for r in token_counts.token_counts(docs(*texts), limit=4).collect()}
    assert [got[i].n_tokens for i in range(len(texts))] == [len(model.encode(t)) for t in texts]
    counter = token_counts.PrefixCounter(path)
    for i, text in enumerate(texts):
        chunks, table = counter.table(text)
        counts, at = {}, 0
        for chunk, before in zip(chunks, table):
            for k, inside in enumerate(counter.inside(chunk)):
                counts[at + k - 1] = int(before) + inside
            at += len(chunk) + 1
        assert all(counts[k] == len(model.encode(text[:k])) for k in range(1, len(text) + 1))
        fits = max(k for k in range(len(text) + 1) if len(model.encode(text[:k])) <= 4)
        assert got[i].fits_chars == fits
    assert [r.n_tokens for r in token_counts.token_counts(edge_rows).collect()][:3] == [0, 0, 0]


def test_stored_tables_hold_every_prefix(docs):
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    texts = ["two  words here", "日本語の文章です。", "", None, "aGVsbG8gd29ybGQhIQ==", " ", "a"]
    got = {r.doc_id: r for r in token_counts.prefix_tables(docs(*texts)).collect()}
    for i, text in enumerate(texts):
        ends = list(range(1, len(text or "") + 1))
        assert got[i].ends == ends and got[i].counts == [len(model.encode(text[:k])) for k in ends]


@pytest.mark.parametrize("compress", [True, False])
def test_warc_round_trip_and_salvage(spark, tmp_path, compress):
    long = "<p>é" + "x" * 200
    pages = spark.createDataFrame(
        [(3, "u 3", long), (1, "u1", long), (2, None, "tiny"), (4, "u4", "tiny"), (5, "u5", None), (None, "u", long),
         (6, "u6", "WARC/1.1\r\n\r\n" + "y" * 300)],
        "page_id long, url string, html string",
    ).coalesce(1)
    path = str(tmp_path / "archive")
    warc.write_warc(pages, path, compress)
    found = {r.page_id: r for r in warc.records(warc.read_warc(spark, path)).collect()}
    assert {k: (r.record_type, r.refers_to) for k, r in found.items()} == {
        1: ("response", None), 3: ("revisit", 1), 2: ("response", None), 4: ("response", None), 5: ("response", None),
        None: ("revisit", 1), 6: ("response", None),
    }
    assert found[3].payload_bytes == len(long.encode()) and found[1].payload.decode() == long
    assert found[3].payload_digest == hashlib.sha256(long.encode()).hexdigest()
    files = [f for f in (tmp_path / "archive").iterdir() if f.name.startswith("part-") and f.stat().st_size]
    data = b"".join(f.read_bytes() for f in files[:1])
    if compress:
        assert gzip.decompress(data).startswith(b"WARC/1.1")
    whole = list(warc.salvage(data))
    offset, length = whole[1][:2]
    broken = data[: offset + length // 2] + b"\x00\x01\x02" + data[offset + length // 2 + 3 :]
    parts = list(warc.salvage(broken))
    assert [p[2] for p in parts if p[2] is not None] == [p[2] for i, p in enumerate(whole) if i != 1]
    assert [(p[0], p[1]) for p in parts if p[2] is None][0][0] == offset
    assert list(warc.salvage(data[:-7]))[-1][2] is None and list(warc.salvage(b"")) == []


def test_warc_files_of_other_names_and_members_of_several_records(spark, tmp_path):
    pages = spark.createDataFrame([(i, f"u{i}", f"<p>{i}</p>" * 30) for i in range(6)], "page_id long, url string, html string")
    warc.write_warc(pages.coalesce(1), str(tmp_path / "plain"), False)
    data = b"".join(f.read_bytes() for f in (tmp_path / "plain").glob("part-*"))
    whole = list(warc.salvage(data))
    assert len(whole) == 6
    offset, length = whole[2][:2]
    broken = data[: offset + length - 40] + b"\x00\x01" + data[offset + length - 38 :]
    folder = tmp_path / "archive"
    folder.mkdir()
    (folder / "crawl-0001.warc.gz").write_bytes(gzip.compress(data))
    (folder / "crawl-0002.warc.gz").write_bytes(gzip.compress(broken))
    (folder / "crawl-0003.warc").write_bytes(data)
    (folder / "_SUCCESS").write_bytes(data)
    (folder / ".crawl.crc").write_bytes(data)
    found = warc.read_warc(spark, str(folder))
    ids = defaultdict(list)
    for r in warc.records(found).collect():
        ids[r.file[-7:]].append(r.page_id)
    names = ("warc.gz", "03.warc")
    assert sorted(ids[names[0]]) == sorted([*range(6), 0, 1, 3, 4, 5]) and sorted(ids[names[1]]) == list(range(6))
    log = warc.gaps(found).collect()
    assert [r.file[-12:] for r in log] == ["0002.warc.gz"] and log[0].offset == 0
    assert log[0].length == len(gzip.compress(broken))


def test_quality_counts_and_guards(docs, edge_rows):
    def good(n):
        return " ".join(f"the w{n}x{i} of" for i in range(60))

    texts = ["a b c a b c x\n\na b\na b", "$# x|y", "a$$$ b%%% c*** " * 3 + " ".join(f"x{i}$$$&&&" for i in range(150))]
    got = {r.doc_id: r for r in quality.quality(docs(*texts, *map(good, range(20)))).collect()}
    assert (got[0].n_words, got[0].n_dup_lines, got[0].n_repeat_words, got[0].word_chars) == (11, 1, 6, 11)
    assert got[1].n_symbols == 3 and not got[2].kept and not got[2].base_failed
    assert all(got[i].kept for i in range(3, 23))
    edge = quality.quality(edge_rows).collect()
    assert len(edge) == 8 and all(r.base_failed for r in edge)
    assert quality.keep_good(docs(good(1), "short", None)).columns == docs("x").columns
    assert [r.doc_id for r in quality.keep_good(docs(good(1), "short", None)).collect()] == [0]
    assert quality.quality(edge_rows.limit(0)).count() == 0


def test_chat_layouts_and_escapes(spark):
    records = [
        '{"messages":[{"role":"user","content":"a"},{"role":"assistant","content":"b"}]}',
        '{"conversations":[{"from":"human","value":"a"},{"from":"gpt","value":"b"}]}',
        '{"prompt":"a","completion":"b"}', '{"instruction":"a","output":"b","system":"s"}',
        '{"instruction":"a","input":"c","output":"b"}', '{"question":"a","answer":"b"}', '{"other":1}', "no json", None,
    ]
    rows = spark.createDataFrame(list(enumerate(records)), "conv_id long, record string")
    turns = {r.conv_id: r.turns for r in chat.canonical_turns(chat.from_json(rows, "record")).collect()}
    plain = [("user", "a"), ("assistant", "b")]
    assert all([tuple(t) for t in turns[i]] == plain for i in (0, 1, 2, 5))
    assert [tuple(t) for t in turns[3]] == [("system", "s"), *plain] and turns[4][0].text == "a\nc"
    assert turns[6] is turns[7] is turns[8] is None
    odd = ["\\", "\\b\\h###", "####", " </turn>\n### user: x", "", None, "</turn></turn>", "é\n🙂"]
    rows = spark.createDataFrame(
        [(1, i, role, text) for i, (role, text) in enumerate(zip(["user", "assistant", "a: b", None] * 2, odd))],
        "conv_id long, turn long, role string, text string",
    )
    written = chat.formatted(chat.canonical_turns(chat.conversation_records(rows)))
    back = chat.read_back(written).first()
    assert [t.text for t in back.turns] == [text or "" for text in odd]
    assert [t.role for t in back.turns] == ["user", "assistant", "a: b", ""] * 2
    assert back.loss_texts == [odd[1], ""]
    assert chat.chat_digest(chat.conversation_records(rows.limit(0))).count() == 0


def test_mixture_meets_its_targets(spark, docs, edge_rows):
    rows = [(i, "w " * (i % 7 + 1), "en", s) for s, n in (("a", 900), ("b", 40), (None, 60), ("c", 300)) for i in range(n)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mixture(table).toPandas()
    assert (got.taken <= 2 * got["size"]).all() and abs(got.taken.sum() - 1.5 * got["size"].sum()) <= 2
    by_target = got.groupby("target").taken.sum()
    assert all(abs(taken - target) <= 0.5 for target, taken in by_target.items())
    cut = mixing.mixed(table)
    assert cut.agg(F.sum(F.regexp_count("text", F.lit(mixing.WORD)))).first()[0] == got.taken.sum()
    assert mixing.mixture(edge_rows).count() == 8 and mixing.mixture(edge_rows.limit(0)).count() == 0
    assert mixing.mixed(docs("a b", "c")).columns[:5] == docs("x").columns[:5]


def test_pseudonyms_keep_format_and_go_back(docs, edge_rows):
    permute, back = pii.Feistel(b"k"), pii.Feistel(b"k", inverse=True)
    for size in (1, 2, 10, 97, 1000):
        assert sorted(permute(i, size, b"t") for i in range(size)) == list(range(size))
    text = ("bob.s@mail7.example.com 4111 1111 1111 1111 4111111111111112 1984-02-29 31.12.1999 12/25/2001 05/06/2001 "
            "123-45-6789 +1 (743) 555-3824 97.51.17.173 999.1.1.1 2024-13-45 DE89 3704 0044 0532 0130 00 token = \"a1b2c3d4e5f6\"")
    coded = pii.pseudonymized(text, permute)
    assert pii.pseudonymized(coded, back) == text
    parts, plain = coded.split(" "), text.split(" ")
    assert pii._luhn("".join(parts[1:5])[:-1]) == int(parts[4][-1])
    assert parts[5] == plain[5] and "999.1.1.1" in coded and "2024-13-45" in coded
    datetime.date.fromisoformat(parts[6])
    assert pii._remainder("".join(parts[-9:-3])) == 1
    assert all(a != b for a, b in zip(parts[6:10], plain[6:10]))
    again = pii.pseudonyms(docs("mail bob.s@mail7.example.com", "to bob.s@mail7.example.com!"), b"k").collect()
    assert again[0].text.split()[1] == again[1].text.split()[1].rstrip("!") and again[0].n_email == 1
    assert [r.text for r in pii.pseudonymize(edge_rows, b"k").collect()] == [r.text for r in edge_rows.collect()]
    assert pii.pseudonymize(docs("x"), b"k").columns == docs("x").columns


def test_cards_and_ibans_are_found_beside_short_tokens():
    permute, back = pii.Feistel(b"k"), pii.Feistel(b"k", inverse=True)

    for card in ("4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111", "3782 822463 10005", "378282246310005"):
        for around in ["%s 12/27", "%s 123", "2 %s", "%s 12", "%s 1 2", "7 %s 09/30 737", "12-%s", "%s-2027", "XX12 %s", "+1 %s",
                       "123456 %s", "12 2024-01-05 %s"] + [f"%s {cvv}" for cvv in range(100, 160)]:
            coded = pii.pseudonymized(around % card, permute)
            assert card not in coded and pii.pseudonymized(coded, back) == around % card, around
            if "2024" not in around:
                assert coded == around % pii.pseudonymized(card, permute)  # equal cards have equal pseudonyms
    for iban in ("ES91 2100 0418 4502 0005 1332", "ES9121000418450200051332", "DE89 3704 0044 0532 0130 00"):
        for around in ("%s BIC", "%s 2024", "AB12 %s", "%s BIC 2024 X", "%s DE89 3704 0044 0532 0130 00"):
            coded = pii.pseudonymized(around % iban, permute)
            assert coded.startswith(around.split("%s")[0] + pii.pseudonymized(iban, permute))
            assert pii.pseudonymized(coded, back) == around % iban and "3704" not in coded
    random.seed(4)
    for _ in range(300):
        text = " ".join(random.choice(["4111 1111 1111 1111", "12", "2024-01-05", "078-05-1120", "ES91 2100 0418 4502 0005 1332",
                                       str(random.randrange(10 ** random.randrange(1, 9)))]) for _ in range(12))
        coded = pii.pseudonymized(text, permute)
        assert "4111 1111 1111 1111" not in coded and pii.pseudonymized(coded, back) == text


def test_main_text_leaves_out_what_is_no_article():
    page = (
        "<html><head><title>t</title></head><body><header>Site</header><nav><a href=x>Menu</a></nav>"
        "<div class='cookie-notice'>We use cookies.</div><div><article><h1>Head &amp; line</h1><p>First <b>para</b>\n graph, long "
        "enough to count as text.<p>Second<br>one, also long enough &eacute;.<aside>Side</aside><form>Name</form></article>"
        "<section id=comments><p>" + "A reader says much. " * 40 + "</p></section></div><footer>foot</footer><script>x='</p>'</script>"
    )
    assert html_text.main_text(page) == (
        "Head & line\nFirst para graph, long enough to count as text.\nSecond one, also long enough é."
    )
    assert html_text.main_text("") == html_text.main_text("<p></p>") == "" and html_text.main_text("plain") == "plain"
    assert html_text.main_text("<div>" * 3000 + "deep") == "deep"


def test_main_text_of_sibling_blocks_without_article():
    def block(letter, paragraphs, chars):
        lines = [" ".join([letter * 9] * (chars // 10)) for _ in range(paragraphs)]
        return "".join(f"<p>{line}</p>" for line in lines), lines

    (a, a_lines), (b, b_lines) = block("a", 10, 200), block("b", 9, 260)
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(30))
    both = ["Title", *a_lines, *b_lines]
    for tag, menu in (("div", ""), ("div", f"<ul>{links}</ul>"), ("section", f"<ul>{links}</ul>")):
        page = f"<body>{menu}<div><h1>Title</h1><{tag}>{a}</{tag}><{tag}>{b}</{tag}></div></body>"
        assert html_text.main_text(page).split("\n") == both
    # Runs of text beside a dense child, and links around blocks, which are no text.
    page = f"<body><div>{'t ' * 300}<b><i>bold</i></b></div><a href=x><div>{a}</div></a></body>"
    assert html_text.main_text(page) == ("t " * 300 + "bold").strip()
    # Several articles are several subtrees; what is beside them is no article.
    page = f"<body><article>{a}</article><div>{'beside ' * 40}</div><article>{b}</article></body>"
    assert html_text.main_text(page).split("\n") == a_lines + b_lines


def test_names_and_forms_leave_out_no_article():
    body = "".join(f"<p>{'word ' * 40}number {i}.</p>" for i in range(6))
    lines = [f"{'word ' * 40}number {i}." for i in range(6)]
    side = "<div class='sidebar'><p>Side words that are not so few.</p></div>"
    for inner in (body + side, f"<article>{body}</article>{side}"):
        for wrap in (
            "<div id=content class='site-content right-sidebar'>%s</div>", "<div class='page no-sidebar'>%s</div>",
            "<form action=/page><input name=state>%s</form>", "<div class=overlay><form><fieldset>%s</fieldset></form></div>",
        ):
            assert html_text.main_text(f"<body>{wrap % inner}</body>").split("\n") == lines, wrap
    extra = (
        "<section id=discussion><p>We discuss it.</p></section><h2 id=related-work>Related work</h2><h2 id=how-to-share>How to"
        " share</h2><p class=notice>Take note.</p><p>As <math><mi>a</mi><mo>=</mo><mn>1</mn></math>.</p>"
    )
    out = "<div class='share-buttons'>Send</div><div class=related-posts>More</div><form>Your mail</form>"
    comments = f"<div class=comments><article class=comment>{body * 3}</article></div>"
    page = f"<body><article>{body}{extra}{out}</article>{comments}<div class='ad-box'>Buy this.</div></body>"
    assert html_text.main_text(page).split("\n") == [
        *lines, "We discuss it.", "Related work", "How to share", "Take note.", "As a=1."
    ]
    page = f"<body><div><h1>Post</h1>{body}</div><div id=comments>{body * 3}</div></body>"
    assert html_text.main_text(page).split("\n") == ["Post", *lines]


def test_language_is_found_on_held_out_rows(spark, sf_dir, edge_rows):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = language_id.held_out_languages(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang == r.lang_pred for r in found]) >= 0.95
    assert {r.lang_pred for r in language_id.predict(edge_rows.limit(4), None).collect()} == {"und"}
    assert language_id.held_out_languages(edge_rows).count() == 8


def test_all_languages_are_learnt(spark):
    random.seed(6)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{k}": ["".join(random.sample(letters, 4)) for _ in range(12)] for k in range(60)}
    rows = [(i, " ".join(random.choices(words[f"l{i % 60}"], k=40)), f"l{i % 60}") for i in range(60 * 16)]
    rows += [(i, rows[0][1], "l0") for i in range(2000, 2100)]
    found = language_id.held_out_languages(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    lang = {i: name for i, _, name in rows}
    assert {r.lang_pred for r in found} == set(words)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in found if r.held_out]) >= 0.95


def test_pipeline_keeps_columns_until_the_mixture(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = corpus_pipeline.run(spark, sf_dir)
    assert found.columns == [*docs.columns, "round", "words"]
    kept = quality.keep_good(docs)
    rejected = {r.doc_id for r in docs.select("doc_id").exceptAll(kept.select("doc_id")).collect()}
    assert found.count() > 0 and not rejected & {r.doc_id for r in found.select("doc_id").distinct().collect()}
