"""Spark-free parts against brute force."""
import random

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from rosterflow.llm import ann, bpe, decontaminate, html_main, minhash, sharding, token_count, toxicity
from rosterflow.llm.common import arrow_slices, text_slices
from rosterflow.llm.queries import tokenizer_file


def test_text_slices_cover_everything():
    texts = ["", "abc", "x" * 50, "", "yy"]
    assert [list(range(a, b)) for a, b in text_slices(texts, 5)] == [[0, 1], [2], [3, 4]]
    assert list(text_slices([], 5)) == []


def test_suffix_automaton_finds_what_brute_force_finds():
    rng = random.Random(1)
    for _ in range(400):
        size, window = rng.randint(1, 4), rng.randint(1, 5)

        def word_list(n):
            return [bytes([97 + rng.randrange(size)]) for _ in range(n)]

        items = [(k % 7, word_list(rng.randint(0, 9))) for k in range(rng.randint(0, 8))]
        words = word_list(rng.randint(0, 40)) + [b"zz"] + word_list(rng.randint(0, 10))
        hit, found = set(), set()
        for item, ws in items:
            k = min(window, len(ws))
            for j in range(len(words) - k + 1) if ws else ():
                if any(words[j:j + k] == ws[i:i + k] for i in range(len(ws) - k + 1)):
                    hit.update(range(j, j + k))
                    found.add(item)
        spans, ids = decontaminate.SuffixAutomaton(items, window).scan(words)
        assert ({x for a, b in spans for x in range(a, b)}, ids) == (hit, found)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_words_of_the_contamination_rule():
    import re
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(chr(rng.choice([*range(128), 0xE9, 0x4E2D, 0x1F600])) for _ in range(60))
        low = text.translate({c: c + 32 for c in range(65, 91)})
        assert [w.decode() for w in decontaminate.words_of(text)] == re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def test_cutting_spans():
    assert decontaminate.without_spans("Hello, big World! and more.", [(1, 3)]) == "Hello, ! and more."
    assert decontaminate.without_spans("one two three", [(0, 3)]) == ""


def test_piece_counter_against_greedy_matching():
    rng = random.Random(3)
    for _ in range(400):
        letters = b"abc"[:rng.randint(1, 3)]
        pieces = {bytes(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(0, 8))}
        words = [bytes(rng.choice(letters) for _ in range(rng.randint(0, 14))) for _ in range(20)]
        want = []
        for w in words:
            i = n = 0
            while i < len(w):
                end = next((j for j in range(len(w), i, -1) if w[i:j] in pieces), 0)
                if not end:
                    n = 1
                    break
                i, n = end, n + 1
            want.append(n)
        assert token_count.PieceCounter(pieces).count(words).tolist() == want


@pytest.mark.parametrize("alphabet", ["ab A1\x1c\x85\xa0​'stre\xe9漢\U0001F600<|endoftext|>\n\t \xb2ⅷ_-́\x00", "ab  \n'll"])
def test_bpe_equals_the_library(alphabet):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file())
    rng = random.Random(4)
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(500)]
    texts += ["", "<|endoftext|>", "a<|endoftext|>b  <|endoftext|> ", "a" * 700, " " * 90, "it's we'll\n\n  they're"]
    model = bpe.Bpe(tokenizer_file())
    ids, counts = model.encode(texts)
    parts = np.split(ids, np.cumsum(counts)[:-1])
    for text, part, want in zip(texts, parts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert part.tolist() == want.ids, repr(text)
    assert model.decode_all(ids, counts) == [library.decode(p.tolist(), skip_special_tokens=False) for p in parts]
    some = [rng.randrange(model.size) for _ in range(300)]
    assert model.decode(some) == library.decode(some, skip_special_tokens=False)


def test_bpe_keeps_runs_of_mixed_white_space_together():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer_file())
    texts = ["a \u00a0 \u00a0 b", "x \u00a0 \u00a0 \u00a0 \u00a0 y", "x\t \ty \u3000 z", "a\n b\u00a0 c", " \u00a0 \u00a0 ", "<|endoftext|>\u00a0 \u00a0 <|endoftext|> \u00a0 b"]
    ids, counts = bpe.Bpe(tokenizer_file()).encode(texts)
    parts = [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])]
    assert parts == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)] and parts[0] == [64, 11504, 275]


def test_shingles_signatures_and_parities():
    sets = minhash.shingle_sets(["a b c", "A  b\tc", "a", "", "a b", "x a b c"], 2)
    assert [len(s) for s in sets] == [2, 2, 1, 0, 1, 3] and (sets[0] == sets[1]).all()
    assert set(sets[0]) < set(sets[5]) and set(sets[4]) < set(sets[0])
    assert minhash.set_digest(sets[0]) == minhash.set_digest(sets[1]) != minhash.set_digest(sets[5])
    places, rows = minhash.permutations(7)
    around = rows[:, 0]
    s = sets[5]
    p = places[(s & np.uint64(minhash.UNIVERSE - 1)).astype(np.int64)]
    want = [min(around[(x + k) % minhash.UNIVERSE] for x in p) for k in range(7)]
    assert minhash.signature(s, 7).tolist() == want
    rng = np.random.default_rng(5)
    a, b = (np.unique(rng.integers(0, 1 << 63, 300, dtype=np.uint64)) for _ in range(2))
    flipped = sum(int(x).bit_count() for x in (minhash.parities(a) ^ minhash.parities(b)).view(np.uint64))
    assert flipped <= len(set(a) ^ set(b))


def test_rotation_keeps_lengths_and_axes_are_nearest():
    x = np.random.default_rng(6).normal(size=(50, 5))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    r = ann.rotated(x, 0)
    assert r.shape == (50, 8) and np.allclose(np.linalg.norm(r, axis=1), 1)
    near = ann.axes(x, 0, 3)
    signed = np.stack([r, -r], axis=2).reshape(50, -1)
    assert (near[:, 0] == signed.argmax(axis=1)).all() and (near[:, :1] == ann.axes(x, 0, 1)).all()
    assert ann.axes(x, 0, 1 << 30).shape == (50, 16)


def neighbours_by_hand(queries, rows, k):
    out = []
    for i in {i for i, _ in queries}:
        score = {}
        for j, w in rows:
            if j != i:
                score[j] = max(score.get(j, -np.inf), max(float(np.cumsum(np.array(v) * np.array(w))[-1]) for h, v in queries if h == i))
        out += [(i, j, s) for j, s in sorted(score.items(), key=lambda x: (-x[1], x[0]))[:k]]
    return sorted(out)


def side(pairs):
    return pd.DataFrame({"vec_id": [i for i, _ in pairs], "v": [np.array(v, dtype=np.float64).tobytes() for _, v in pairs]})


def test_nearest_count_an_id_once_among_repeats_ties_and_copies():
    rng = random.Random(14)
    for _ in range(150):
        values = [-1.0, 0.0, 0.5, 1.0][:rng.randint(2, 4)]
        rows = [(rng.randrange(rng.choice([3, 12, 40])), [rng.choice(values) for _ in range(3)]) for _ in range(rng.randint(1, 40))]
        rows += [rng.choice(rows)] * rng.choice([0, 30])
        queries, k = rng.choices(rows, k=5), rng.randint(1, 6)
        got = ann.nearest_in(side(queries), side(rows), k)
        assert sorted(map(tuple, got.itertuples(index=False))) == neighbours_by_hand(queries, rows, k)


def test_a_large_group_of_equal_vectors_is_compared_once():
    import tracemalloc
    copies = [(i, [0.6, 0.8] * 32) for i in range(3000)]
    tracemalloc.start()
    got = ann.nearest_in(side(copies[:1000]), side(copies), 20)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == 20_000 and peak < 200e6         # all tied pairs took 1.5 GB for each temporary
    assert got[got.query_id == 7].vec_id.tolist() == [*range(7), *range(8, 21)]


def test_schedule_is_longest_first_to_the_least_loaded():
    assert sharding.schedule([(7, "a"), (5, "b"), (4, "c"), (3, "d")], 2) == {"a": 0, "b": 1, "c": 1, "d": 0}
    assert sharding.schedule([], 3) == {}


def test_folding_and_exceptions():
    assert toxicity.folded_words("1D10T, mоrоn! stüpid id​iot $cum 2024 100") == ["idiot", "moron", "stupid", "idiot", "scum"]
    matcher = toxicity.Lexicon({" trash ": 2.0, " idio": 1.0, " idiot ": 3.0})
    assert matcher.weigh(["trash", "can"]) == 0
    assert matcher.weigh(["trash"]) == pytest.approx(2 / 11 ** 0.5)
    assert matcher.weigh(["idiots", "idiot"]) == pytest.approx(4 / 12 ** 0.5)
    assert matcher.weigh([]) == 0


def blocks(html):
    found = html_main.Page(html).open_blocks()
    return [text for text, place, _ in found if place == max(p for _, p, _ in found)]


def test_main_blocks():
    page = """<html><head><title>x</title><script>var a="<p>no</p>"</script></head><body><header><h1>Site</h1></header><nav><ul><li>Home</ul></nav>
    <div class="cookie-notice">We use</div><main><article><header><h1>Tit&amp;le</h1><span>by me</span></header><p>One <b>two</b>&nbsp;three<p>four<br>five
    <ul><li>a<li>b</ul><div class=ad>buy</div><!-- <p>c --><section id="comments"><article>hey</article></section><form>f</form></article>
    <aside>s</aside></main><footer>f</footer>"""
    assert blocks(page) == ["Tit&le", "One two three", "four five", "a", "b"]
    assert blocks("<body><main><p>m</main><p>out") == ["m"]
    assert blocks("<article>short</article><article>the longer one</article>") == ["short", "the longer one"]
    assert blocks("<p hidden>x</p><p style='display: none'>y</p><p>z</p>") == ["z"]


@pytest.mark.parametrize("tag", ["form", "dialog", "fieldset", "form><fieldset"])
def test_an_article_in_a_wrapper_counts_if_there_is_no_other(tag):
    end = "".join(f"</{t.strip('<')}>" for t in reversed(tag.split(">")))
    assert blocks(f"<body><{tag}><label>Search</label><article><p>The story</p></article><input>{end}") == ["The story"]
    assert blocks(f"<body><{tag}><main><p>The story</main>{end}") == ["The story"]
    assert blocks(f"<body><{tag}><article><p>We use cookies</p></article>{end}<article><p>The story</p></article>") == ["The story"]
    assert blocks(f"<body><{tag}><p>Name</p>{end}<p>The story</p>") == ["The story"]
    assert blocks(f"<nav><{tag}><article>Menu</article>{end}</nav><p>The story</p>") == ["The story"]


@pytest.mark.parametrize("wrapped", ['<div class="content-sidebar-wrap">{}</div>', '<div class="has-sidebar"><div>{}</div></div>', "{}"])
def test_a_word_of_class_does_not_drop_the_article(wrapped):
    page = wrapped.format('<article class="post category-social tag-cookies"><p>The story of the day</p><div class="share">Share</div></article>')
    assert blocks(f"<body>{page}</body>") == ["The story of the day"]
    assert blocks(f"<body>{page.replace('article', 'div')}<p>x</p></body>")[0] == "The story of the day"


@pytest.mark.parametrize("html", ["", "<", "<a", "<p", "</p></div>", "<script>a", "<!--", '<p title="x>y', "<div>" * 300 + "x", "\x00", "&#xZZ; &am &amp;"])
def test_broken_pages_do_not_crash(html):
    html_main.Page(html).open_blocks()


def test_arrow_slices_make_strings_of_one_part_at_a_time():
    texts = ["é" * 30, None, "", "x" * 500, *["ab"] * 40]
    parts = list(arrow_slices(pa.array(["before", *texts])[1:], limit=100))
    assert [t for _, part in parts for t in part] == [t or "" for t in texts]
    assert [start for start, _ in parts] == [0, 3, 4] and all(sum(len(t.encode()) for t in part) <= 100 or len(part) == 1 for _, part in parts)
    assert list(arrow_slices(pa.array([], pa.string()))) == []
