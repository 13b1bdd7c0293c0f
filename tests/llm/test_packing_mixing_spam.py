import random
from collections import Counter

import pytest

from lexmesh.llm.mixing import feasible_total, mix_sources, sainte_lague
from lexmesh.llm.packing import container_fill, pack_documents, packing_patterns, slots_of
from lexmesh.llm.spam import page_features, spam_pages, spam_scores
from lexmesh.llm.tokens import PIECE_CHARS, count_tokens, encoding

DOC = "doc_id long, text string, source string, kind int, rank string"
SIZES = "container_kind string, capacity_tokens int"


@pytest.mark.parametrize("seed", range(5))
def test_patterns_hold_every_item_once(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 64, 500])
    items = Counter(rng.randrange(1, capacity + 1) for _ in range(rng.randrange(1, 400)))
    patterns = packing_patterns(items, capacity)
    placed = Counter()
    for pattern, count in patterns:
        assert sum(n * k for n, k in pattern) <= capacity
        for n, k in pattern:
            placed[n] += k * count
    assert placed == items
    assert sum(c for _, c in patterns) <= 1.35 * sum(n * k for n, k in items.items()) / capacity + 2
    runs, total = slots_of(patterns)
    assert total == sum(c for _, c in patterns) and set(runs) == set(items)


def texts(n, seed=1):
    rng = random.Random(seed)
    words = "kelp survey of the northern coast and its harbour in winter".split()
    out = [(i, " ".join(rng.choices(words, k=rng.choice([3, 3, 3, 20, 60, 300]))), rng.choice(["big", "big", "big", "small", "tiny "]), 1, "x") for i in range(n)]
    return out + [(n, "", "big", 1, "x"), (n + 1, None, "big", 1, "x"), (None, "kelp", "big", 1, "x"), (0, out[0][1], out[0][2], 1, "x")]


def test_every_text_is_placed(spark):
    data = texts(200)
    docs, sizes = spark.createDataFrame(data, DOC).repartition(7), spark.createDataFrame([("s", 16), ("m", 64), ("none", None)], SIZES)
    packed = pack_documents(docs, sizes)
    got = packed.collect()
    size = {i: count_tokens(t) for i, t, *_ in data if i is not None}
    for kind, capacity in (("s", 16), ("m", 64)):
        mine = [r for r in got if r.container_kind == kind]
        used, seen = Counter(), Counter()
        for r in mine:
            used[r.container_id] += r.piece_tokens
            seen[r.doc_id] += r.piece_tokens
        assert max(used.values()) <= capacity and sorted(used) == list(range(len(used)))
        assert all(seen[i] == n * (2 if i == 0 else 1) for i, n in size.items()) and set(size) == {r.doc_id for r in mine}
        for i, n in size.items():  # divided only beyond the capacity
            assert i == 0 or len([r for r in mine if r.doc_id == i]) == max(1, -(-n // capacity))
    fill = {r.container_kind: r for r in container_fill(packed, sizes).groupBy("container_kind").avg("fill").collect()}
    assert all(r["avg(fill)"] > 0.9 for r in fill.values())
    again = pack_documents(docs.repartition(2), sizes)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got))


def test_packing_empty(spark):
    assert pack_documents(spark.createDataFrame([], DOC), spark.createDataFrame([("s", 16)], SIZES)).count() == 0
    assert pack_documents(spark.createDataFrame(texts(3), DOC), spark.createDataFrame([], SIZES)).count() == 0


def test_long_texts_are_counted_whole():
    rng = random.Random(2)
    text = "".join(rng.choice(["kelp ", "a1 ", "\n\n", "  ", "é", "... ", "it's "]) for _ in range(PIECE_CHARS // 2))
    assert len(text) > PIECE_CHARS and count_tokens(text) == len(encoding("/opt/tokenizers/byte_bpe_50k.tiktoken").encode_ordinary(text))


def brute_seats(weights, seats, caps):
    given = dict.fromkeys(weights, 0)
    for _ in range(seats):
        live = [k for k in weights if given[k] < caps[k]]
        if not live:
            break
        k = min(live, key=lambda k: (-weights[k] / (2 * given[k] + 1), k))
        given[k] += 1
    return given


@pytest.mark.parametrize("seed", range(8))
def test_sainte_lague_matches_seat_by_seat(seed):
    rng = random.Random(seed)
    w = {f"s{i}": rng.choice([1.0, 2.0, 0.3, 7.5, rng.random()]) for i in range(rng.randrange(1, 6))}
    seats = rng.randrange(0, 80)
    caps = {k: rng.choice([seats, 3, 10]) for k in w}
    assert sainte_lague(w, seats, caps) == brute_seats(w, seats, caps)


def test_mix_meets_shares_and_caps(spark):
    docs = spark.createDataFrame(texts(400, 3), DOC)
    targets = spark.createDataFrame([("m", "big", 2.0, 1), ("m", "small", 1.0, 2), ("m", " tiny", 1.0, 3), ("m", "absent", 1.0, 3), ("n", "big", 1.0, 1), ("n", "tiny", 0.0, 2), ("o", None, 1.0, 1)], "mix_name string, source string, target_weight double, max_repeats int")
    chosen, shares = mix_sources(docs, targets)
    got = {(r.mix_name, r.source): r for r in shares.collect()}
    assert got["m", "absent"].actual_share == 0 and set(got) == {("m", "big"), ("m", "small"), ("m", "tiny"), ("m", "absent"), ("n", "big")}
    for s, w in (("big", 0.5), ("small", 0.25), ("tiny", 0.25)):
        assert got["m", s].actual_share == pytest.approx(w, abs=0.02)
    rows = chosen.collect()
    assert max(r.repeats for r in rows if r.source == "tiny") <= 3 and all(r.repeats == 1 for r in rows if r.source == "big")
    assert len({(r.mix_name, r.doc_id) for r in rows}) == len(rows)
    large, capped = mix_sources(docs, targets, total_tokens=10**9)
    assert all(r.repeats == {"big": 1, "small": 2, "tiny": 3}[r.source] for r in large.filter("mix_name = 'm'").collect())
    assert feasible_total({"a": 1.0, "b": 3.0}, {"a": 100, "b": 90}) == 120
    empty, _ = mix_sources(docs.filter("false"), targets)
    assert empty.count() == 0


def prose(rng):
    subject = ["the office", "a reader", "every entry on kelp", "our note", "the second reviewer", "whoever looks for silt"]
    verb = ["was merged with", "should be read together with", "takes precedence over", "does not replace", "is often confused with"]
    thing = ["harbour dues", "soil tests", "the older record", "pension claims", "coastal wetland", "vessel crew", "tenure"]
    return " ".join(f"{rng.choice(subject).capitalize()} {rng.choice(verb)} {rng.choice(thing)}, although {rng.randrange(999)} records differ." for _ in range(rng.randrange(2, 9)))


def junk(rng):
    kw = rng.sample(["coastal kelp", "urban silt", "tidal levy", "fiscal crew", "rural tenure"], 2)
    mod = ["buy", "cheap", "best", "sale", "online", "price", ""]
    style = rng.randrange(4)
    n = rng.randrange(8, 40)
    one = lambda: " ".join(filter(None, rng.sample([rng.choice(mod), rng.choice(kw)], 2)))
    if style == 0:
        return ", ".join(one() for _ in range(n))
    if style == 1:
        return "\n".join(f"{one()} https://shop{rng.randrange(99)}.example/{rng.randrange(999)}" for _ in range(n))
    if style == 2:
        return " ".join(f"{one()} {rng.choice(['for the', 'and', 'with', 'in our'])}" for _ in range(n))
    return prose(rng).split(".")[0] + ".\n" + "\n".join(f"<a href='www.x{i}.example'>{one()}</a>" for i in range(n))


def test_spam_is_told_from_text(spark):
    rng = random.Random(7)
    data, truth = [], set()
    for i in range(500):
        bad = i % 6 == 0
        truth |= {i} if bad else set()
        data.append((i, junk(rng) if bad else prose(rng) + ("\n\n[1] https://ref.example/long/path/to/some/source?id=1" if i % 5 == 0 else ""), "crawl" if i % 3 == 0 else " press", 1, "x"))
    data += [(900, "", "press", 1, "x"), (901, None, None, 1, "x"), (902, " \n\t", "press", 1, "x"), (None, "x", "press", 1, "x")]
    found = {r.doc_id for r in spam_pages(spark.createDataFrame(data, DOC)).collect()}
    assert len(found & truth) / len(truth) > 0.95 and len(found - truth) <= 3 and not found & {900, 901, 902}


def test_spam_without_training_cases(spark):
    df = spark.createDataFrame([(1, "buy kelp, cheap kelp, best kelp, kelp sale", "a", 1, "x"), (2, "buy kelp, cheap kelp, kelp online, kelp", "a", 1, "x")], DOC)
    assert {r.doc_id for r in spam_pages(df).collect()} == {1, 2}
    assert spam_scores(df.filter("false")).count() == 0
    assert page_features(None) == page_features("")


def test_prose_of_unlisted_languages_is_no_spam():
    from lexmesh.llm.spam import FEATURES, page_features

    poor = lambda text: page_features(text)[FEATURES.index("poor_chars")]
    polish = "W latach sześćdziesiątych mieszkańcy wsi nad Wisłą zaczęli spisywać poziom wody, bo co kilka lat rzeka wylewała na pola. Z tych zapisków wynika, że największa powódź przyszła w maju i trwała do połowy czerwca."
    russian = "В этом разделе описано, как редакторы сверяли старые записи с новыми. Если источник не дает определения, его берут из справочника, и это отмечают в примечании. По мнению комиссии, таких случаев не так много, но они есть."
    chinese = "这份说明介绍了编辑如何核对旧记录。如果来源没有给出定义，就从手册中选取，并在备注中注明。委员会认为这种情况不多，但确实存在。"
    assert [poor(x) for x in (polish, russian, chinese)] == [0.0, 0.0, 0.0]
    keywords = "tani kredyt hipoteka tani kredyt bank tani kredyt hipoteka ranking kredyt tani kredyt online hipoteka tani kredyt bank kredyt tani kredyt"
    assert poor(keywords) == 1.0 and poor("https://a.example/x\nhttps://b.example/y") == 1.0 and poor(None) == 0.0
