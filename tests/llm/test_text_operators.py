"""Operators 1, 2, 4, 6, 7, 9 and 10 against brute force and on edge cases."""

import math
import random
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import pii_base, quality_base, sha, words
from pyspark.sql import functions as F

from claimlens.llm import chat_format, fingerprints, mixing, packing, pii, quality_rules, toxicity
from claimlens.llm.common import components

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def odd_rows(spark):
    """Nulls, empty and very long texts, repeated rows, and extra columns with names the operators use."""
    rows = [(1, None, "s"), (2, "", "s"), (3, " \t\n", None), (4, "word " * 30000, "s"), (4, "word " * 30000, "s"), (None, "x y", "t"), (5, "é" * 50000, None)]
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], "doc_id long, text string, source string, _key string, spans string, size string")


# ------------------------------------------------------------------ packing

def test_bounds_never_exceed_a_packing():
    rnd = random.Random(1)
    for _ in range(100):
        length = np.array([rnd.randint(1, 20) for _ in range(rnd.randint(1, 50))])
        bins, offset, used = packing.best_fit(length, 20)
        assert packing.lower_bound(np.bincount(length, minlength=21), 20) <= used
        for b in range(used):
            spans = sorted(zip(offset[bins == b], length[bins == b]))
            assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))] and sum(n for _, n in spans) <= 20


def test_pieces_match_the_tokenizer_and_sequences_are_gapless(docs, texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())
    rows = packing.pack_documents(docs).collect()
    got, room = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        room[r.sequence_id].append((r.offset, r.length))
    for d, t in texts.items():
        ids = np.array([*tok.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        assert sorted(got[d]) == [(k, k * 2048, len(p), zlib.crc32(p.tobytes())) for k, p in
                                  enumerate(ids[i:i + 2048] for i in range(0, len(ids), 2048))]
    for spans in room.values():
        spans.sort()
        assert [o for o, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))] and sum(n for _, n in spans) <= 2048


@pytest.mark.parametrize("text", ["Don't STOP, e.g. it's 5'2\"; l'été. ÉTÉ! ǰ J̌ ΣΟΦΟΣ", "<|endoftext|> <|ENDOFTEXT|>.", "a b ć x²½ 日本語。", "İ. ß, ﬁ!"])
def test_words_give_the_ids_of_the_text(spark, text):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.tokenizer_path())
    row = packing.token_pieces(spark.createDataFrame([(1, text)], "doc_id long, text string"), keep_ids=True).first()
    assert row.ids == [*tok.encode(text, add_special_tokens=False).ids, 0]


def test_groups_exchange_pieces(spark):
    rnd = random.Random(3)
    pieces = spark.createDataFrame([(i, rnd.randint(300, 1400)) for i in range(600)], "doc_id long, length long")
    packed, report = packing.pack(pieces, per_group=60)
    assert packed.count() == 600 and packed.select("sequence_id").distinct().count() == report["bins"] >= report["bound"]
    assert report["rounds"] == sorted(report["rounds"], reverse=True)
    assert packing.pack(pieces.where("false"))[0].count() == 0


def test_exchange_goes_on_while_rounds_save_bins(spark, monkeypatch):
    rnd = random.Random(3)
    pieces = spark.createDataFrame([(i, rnd.randint(200, 1000)) for i in range(600)], "doc_id long, length long")
    said = iter([1000] + [1] * 6 + [10 ** 6])  # six rounds that save bins, then one that does not
    monkeypatch.setattr(packing, "_bins", lambda placed: next(said))
    whole = packing._pack_groups
    monkeypatch.setattr(packing, "_pack_groups", lambda *args: whole(*args).withColumn("_bound", F.lit(0).cast("long")))  # no group is certified
    packed, report = packing.pack(pieces, per_group=20)
    assert len(report["rounds"]) == 7
    rows = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.count("*").alias("m")).collect()
    assert sum(r.m for r in rows) == 600 and max(r.n for r in rows) <= packing.CAPACITY


def test_unknown_words_go_to_the_tokenizer_by_slices():
    from tokenizers import Tokenizer
    from claimlens.llm.textbytes import Chunk

    class Seen:
        def __init__(self, tok):
            self.tok, self.most = tok, 0

        def encode_batch_fast(self, texts, **more):
            self.most = max(self.most, len(texts), *(len(t.split()) for t in texts)) if texts else self.most
            return self.tok.encode_batch_fast(texts, **more)

    rng = random.Random(3)
    text = " ".join("".join(rng.choices("abcdefgh1é", k=7)) for _ in range(20_000))
    enc = packing.WordEncoder(packing.tokenizer_path())
    enc.tok, enc.bare = Seen(enc.tok), Seen(enc.bare)
    raw = np.frombuffer(text.encode(), np.uint8)
    ids, _ = enc.encode(Chunk(None, raw, np.array([0, len(raw)])))
    assert ids.tolist() == Tokenizer.from_file(packing.tokenizer_path()).encode(text, add_special_tokens=False).ids
    assert 0 < max(enc.tok.most, enc.bare.most) <= 4096


def test_texts_go_to_packing_in_small_batches(spark, docs, monkeypatch):
    name, write, seen = "spark.sql.execution.arrow.maxRecordsPerBatch", packing.write_table, []
    monkeypatch.setattr(packing, "write_table", lambda df, to: (seen.append((to, int(spark.conf.get(name)))), write(df, to))[1])
    before = spark.conf.get(name)
    packing.pack_documents(docs)
    assert dict(seen)["pieces"] <= 1000 and spark.conf.get(name) == before


def test_packing_odd_rows(spark):
    rows = packing.pack_documents(odd_rows(spark)).collect()
    assert [r.length for r in rows if r.doc_id in (1, 2, 3)] == [1, 1, 1] and sum(r.length for r in rows if r.doc_id == 4) == 60002
    seq = packing.sequences(packing.pack(packing.token_pieces(odd_rows(spark), keep_ids=True))[0]).collect()
    assert all(len(r.ids) <= 2048 for r in seq) and sum(len(r.ids) for r in seq) == sum(r.length for r in rows)


# ------------------------------------------------------------------ chat

def test_chat_round_trip(spark):
    rows = [(1, 0, "user", "plain\\"), (1, 1, "assistant", "x\n</turn>\n### user:\ny"), (1, 1, "assistant", "x\n</turn>\n### user:\ny"),
            (1, 2, "a:b\n%0A", "\\### Assistant: \\\\</turn>"), (2, None, None, None), (2, 3, "assistant", "</turn>"), (None, 0, "assistant", "### "),
            (3, 0, "user", "z" * 200000)]
    t = spark.createDataFrame([(*r, "k") for r in rows], "conv_id long, turn int, role string, text string, formatted string")
    done = chat_format.format_conversations(t)
    back = {r.conv_id: r for r in chat_format.read_back(done).collect()}
    for r in done.collect():
        mine = [(x[2] or "", x[3] or "") for x in sorted((x for x in rows if x[0] == r.conv_id), key=lambda x: (x[1] is not None, x[1]))]
        loss = "".join(x for role, x in mine if role == "assistant")
        b = back[r.conv_id]
        assert b.round_trip and b.n_turns == len(mine) and b.formatted_chars == len(r.formatted)
        assert b.turns_sha256 == sha("".join(f"{role}\n{x}\n" for role, x in mine).encode())
        assert (b.loss_chars, b.loss_sha256) == (len(loss), sha(loss.encode()))
        under = [r.formatted[s.start:s.start + s.length] for s in r.loss_spans]
        plain = spark.createDataFrame([(i, u) for i, u in enumerate(under)], "i int, u string").select("i", chat_format.unescape(F.col("u")).alias("u")) if under else None
        assert "".join(x.u for x in sorted(plain.collect())) == loss if under else loss == ""
    assert chat_format.read_back(chat_format.format_conversations(t.where("false"))).count() == 0
    moved = F.transform("loss_spans", lambda s: F.struct((s["start"] + 1).alias("start"), s["length"].alias("length")))
    shifted = {r.conv_id: r for r in chat_format.read_back(done.withColumn("loss_spans", moved)).collect()}
    some = [c for c in back if back[c].loss_chars]
    assert some and all(shifted[c].loss_sha256 != back[c].loss_sha256 and shifted[c].round_trip for c in some)  # the digest reads the mask


# ------------------------------------------------------------------ quality

def test_quality_counts(spark, docs, texts):
    got = {r.doc_id: tuple(r)[1:7] for r in quality_rules.quality_report(docs).collect()}
    assert got == {d: quality_base(t) for d, t in texts.items()}
    odd = odd_rows(spark)
    assert sorted(tuple(r)[1:7] for r in quality_rules.quality_report(odd).collect()) == sorted(quality_base(r.text) for r in odd.collect())


def test_repeated_windows_are_found_beside_colliding_ones(spark):
    # the hashes of "x y z1067006" and "x y z1669463" agree in their last 38 bits
    text = " ".join(f"x y z{k} v{i}" for i, k in enumerate((1067006, 1669463, 1067006)))
    got = quality_rules.quality_report(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert got.n_repeat_words == quality_base(text)[4] == 6


def test_failed_lines_go_and_clean_documents_stay(spark):
    clean = "\n".join(" ".join(f"a{i}b{k}" for k in range(9)) + ", and so on." for i in range(12))
    dirty = clean + "\nHome | About | Contact | Login\nBUY NOW!! CHEAP!! WOW!!\nClick here to continue."
    junk = "\n".join(f"go{i} | to{i} | page{i} | now{i}" for i in range(30))
    rows = spark.createDataFrame([(1, clean, "k"), (2, dirty, "k"), (3, junk, "k"), (4, "short.", "k"), (5, None, "k")], "doc_id long, text string, _q string")
    kept = {r.doc_id: r for r in quality_rules.keep_clean(rows).collect()}
    assert set(kept) == {1, 2} and kept[1].text == kept[2].text == clean and kept[1]["_q"] == "k"


# ------------------------------------------------------------------ toxicity

def test_toxicity_learns_words_and_never_sees_held_out_labels(spark):
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(500)]
    rows, labels = [], []
    for i in range(1200):
        bad = rnd.random() < 0.2
        w = rnd.choices(vocab, k=40) + (["dolt", "oaf"] if bad else [])
        rnd.shuffle(w)
        rows.append((i, " ".join(w), "k"))
        labels.append((i, int(bad)))
    d = spark.createDataFrame(rows, "doc_id long, text string, score string")
    truth = dict(labels)
    wrong = [(i, 1 - y if zlib.crc32(str(i).encode()) % 4 == 2 else y) for i, y in labels] + [(None, 1), (5, None), (99999, 1)]
    got = toxicity.toxicity_report(d, spark.createDataFrame(wrong, "doc_id long, toxic int")).collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in range(1200) if zlib.crc32(str(i).encode()) % 4 == 2}
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)


def test_toxicity_odd_rows(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    got = toxicity.toxicity_report(odd_rows(spark), none).collect()
    assert len(got) == 7 and {r.score for r in got} == {0.5}
    assert toxicity.toxicity_report(odd_rows(spark).where("false"), none).count() == 0


# ------------------------------------------------------------------ fingerprints

def bag(t):
    c = Counter(words(t)) or {t: 1}
    return {w: n * max(1, len(w)) ** 2 for w, n in c.items()}


def similarity(a, b):
    a, b = bag(a), bag(b)
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in {*a, *b}) / sum(max(a.get(k, 0), b.get(k, 0)) for k in {*a, *b})


def test_fingerprints_estimate_generalised_jaccard(docs, texts):
    got = {r.doc_id: r for r in fingerprints.fingerprint_report(docs).collect()}
    ids = sorted(texts)
    off, by_text = [], defaultdict(set)
    for d, n in zip(ids, ids[1:] + ids[:1]):
        t, q = texts[d], len(texts[d]) // 4
        edited = t[:len(t) - q] + texts[n][:q]
        r = got[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), sha(edited.encode()))
        off += [r.near_edited - similarity(t, edited), r.near_next - similarity(t, texts[n])]
        by_text[t].add(r.fingerprint)
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.1 and all(len(v) == 1 for v in by_text.values())


def test_fingerprints_odd_rows(spark):
    got = fingerprints.fingerprint_report(odd_rows(spark)).collect()
    assert len(got) == 7 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].near_next == 1 and by_id[1].fingerprint == by_id[2].fingerprint  # null is the empty text
    one = fingerprints.fingerprint_report(odd_rows(spark).where("doc_id = 5")).first()
    assert one.near_next == one.near_edited == 1
    assert fingerprints.fingerprint_report(odd_rows(spark).where("false")).count() == 0


def test_wrapped_prose_and_other_scripts_stay(spark):
    write = lambda c: textwrap.fill(" ".join(" ".join(f"{c}{i}{k}" for k in "abcdefghijklmnopqrstu") + "." for i in range(12)), 72)
    wrapped = write("mail")
    hindi = "\n".join(" ".join(f"शब्द{i}क{k}" for k in range(9)) + " है।" for i in range(12))
    wide = "\n".join(" ".join(f"語{i}字{k}" for k in range(9)) + " です！" for i in range(12))
    arabic = "\n".join(" ".join(f"كلمة{i}ب{k}" for k in range(9)) + " لماذا؟" for i in range(12))
    thai = "\n".join(" ".join(f"คำ{i}ก{k}" for k in range(9)) for i in range(12))
    clean = [wrapped, hindi, wide, arabic, thai, wrapped + "\n\n" + write("book")]
    listed = "\n".join(f"home{i} about{i} contact{i} login{i}" for i in range(20))
    rows = [*enumerate(clean), (10, listed), (11, wrapped + "\n\nmenu about contact login\n\n" + write("book")), (12, wrapped + "\nmenu about contact login\nBUY NOW!! CHEAP!!")]
    kept = {r.doc_id: r.text for r in quality_rules.keep_clean(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert {d: kept.get(d) for d in range(len(clean))} == dict(enumerate(clean))
    assert set(kept) == {*range(len(clean)), 11, 12} and "menu" not in kept[11] and kept[12] == wrapped


# ------------------------------------------------------------------ mixing

def test_targets_and_tree():
    assert mixing.targets([100, 10, 1000]) == [270.0, 30.0, 810.0]  # the second stops at 3 x 10
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0.0, 0.0]
    for shards in (1, 3, 8):
        grown = list(mixing.leaves([100, 3, 0, 41], shards, 0, shards))
        tree = np.stack([count for _, _, count in grown])
        assert [k for k, _, _ in grown] == list(range(shards))
        assert all((first == tree[:k].sum(axis=0)).all() for k, first, _ in grown)
        for lo in range(shards):  # any part of the tree grows alone
            part = list(mixing.leaves([100, 3, 0, 41], shards, lo, min(shards, lo + 2)))
            assert all((a[2] == b[2]).all() and (a[1] == b[1]).all() for a, b in zip(part, grown[lo:lo + 2]))
        assert tree.sum(axis=0).tolist() == [100, 3, 0, 41] and np.ptp(tree.sum(axis=1)) <= 2 and (tree >= 0).all()


def test_mix_holds_the_taken_words(docs):
    taken = {r.doc_id: r for r in mixing.taken_words(docs).collect()}
    rows = mixing.mix_rows(docs, block_words=500, shard_words=20000)
    got = rows.collect()
    times = Counter(r.row.doc_id for r in got)
    assert all(times[d] * r["size"] == r.taken and times[d] <= 3 for d, r in taken.items())
    for shard in {r.shard for r in got}:
        place = sorted(r.position for r in got if r.shard == shard)
        assert place == list(range(1, len(place) + 1))
    assert sorted(mixing.mix(docs, 500, 20000).collect()) == sorted(r.row for r in got)


def test_taken_words_count_the_dealt_copies(docs, monkeypatch):
    rows = mixing.sized(docs)
    formula = {r.doc_id: r["size"] * r.copies for r in mixing._planned(rows, mixing.plan(rows)).collect()}
    monkeypatch.setattr(mixing.assignments, "__defaults__", (500, 20000, mixing.SEED))
    assert {r.doc_id: r.taken for r in mixing.taken_words(docs).collect()} == formula
    grown = mixing.drawn_blocks
    monkeypatch.setattr(mixing, "drawn_blocks", lambda *args: grown(*args).where("_src <> 0"))  # the blocks of one source are lost
    assert 0 < sum(r.taken for r in mixing.taken_words(docs).collect()) < sum(formula.values())


def test_mixing_odd_rows(spark):
    odd = odd_rows(spark)
    got = mixing.taken_words(odd).collect()
    assert len(got) == 7 and all(r.taken <= 3 * r["size"] for r in got)
    assert sum(r.taken for r in got) == sum(r["size"] for r in mixing.mix(odd).select(F.regexp_count("text", F.lit(mixing.WORD)).alias("size")).na.fill(0).collect())
    assert mixing.taken_words(odd.where("false")).count() == mixing.mix(odd.where("false")).count() == 0


# ------------------------------------------------------------------ personal data

def test_pii_base_spans(spark):
    rnd = random.Random(2)
    rows = [(i, "".join(rnd.choices("ab.@-+1 23é(0)_%x4", k=rnd.randint(0, 120)))) for i in range(800)]
    rows += [(2000, "a@" + "b." * 20000 + "c"), (2001, "1 " * 30000), (2002, "1" * 60000), (2003, "x" * 100000), (2004, None), (2005, ""),
             (2006, "1.2.3.4.5.6.7.8 999.1.1.1 001.2.3.4"), (2007, "4111 1111 1111 1111 \x01 4111\x011111 1111 1111"), (2008, "a@b.com.x_y@c.org")]
    d = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, spans string")
    assert {r.doc_id: tuple(r)[1:6] for r in pii.report(d).collect()} == {i: pii_base(t) for i, t in rows}


def test_terms_that_disclose_an_entity_go(spark):
    rows = [(i, f"Call Zorgblat about case{i} via kim@zz.org on day{i}.") for i in range(6)]
    rows += [(50 + i, f"Call someone about thing{i} via shop{i}@zz.org.") for i in range(6)] + [(99, "Call zorg about day1.")]
    d = spark.createDataFrame([(*r, 7, "k") for r in rows], "doc_id long, text string, n_chars long, base string")
    got = {r.doc_id: r for r in pii.sanitise(d).collect()}
    # the name is only there with the address (removed); "via" in half of its documents (generalised); the others in fewer
    assert got[0].text == "Call  about case0 [TERM] [EMAIL] on day0." and got[0].n_chars == len(got[0].text)
    assert got[50].text == "Call someone about thing0 via [EMAIL]." and got[99].text == rows[-1][1]
    copies = spark.createDataFrame([(i, rows[0][1]) for i in range(9)], "doc_id long, text string")
    assert {r.n_term for r in pii.report(copies).collect()} == {0}  # copies are one context


def test_rare_names_that_disclose_an_entity_go(spark):
    once, copied = "Please call Zorgblat via kim@zz.org about the order.", "Please call Quuxley via ann@zz.org about the order."
    rows = [(i, f"Please call us via shop{i}@zz.org about the order.") for i in range(80)] + [(i, "Nothing to order.") for i in range(80, 100)]
    rows += [(100, once), (101, copied), (102, copied)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.sanitise(d).collect()}
    assert got[100] == got[101] == got[102] == "Please call  via [EMAIL] about the order."
    assert got[0] == "Please call us via [EMAIL] about the order." and got[99] == rows[99][1]


def test_rows_that_share_an_id_are_sanitised_each_by_its_own_text(spark):
    rows = [(None, "Mail a@b.org now."), (None, "No address here, but 10.0.0.1 is."), (7, "x@y.org"), (7, "Call +49 30 1234567 x.")]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(None, "Mail [EMAIL] now."), (None, "No address here, but [IP] is."), (7, "[EMAIL]"), (7, "Call [PHONE] x.")]
    assert sorted(map(str, pii.sanitise(d).collect())) == sorted(map(str, spark.createDataFrame(want, d.schema).collect()))


def test_context_words_come_from_the_whole_text_and_repeated_rows_count_once(spark):
    far = " ".join(f"{chr(97 + i)}long" + "x" * 900 for i in range(8))
    rows = [(i, f"{far}{i} kim@zz.org {far}") for i in range(3)]
    d = spark.createDataFrame(rows, "doc_id long, text string")
    words = [w for w in far.split(" ")]
    for r in pii.find_base(d).collect():
        assert r.contexts[0].words == words[:-1] + [words[-1] + str(r.doc_id)] + words
    rows = [(i, f"Nothing here {i}.") for i in range(60)] + [(70, "Ask Zorgblat or kim@zz.org."), (71, "Here is Zorgblat.")] + [(70, "Ask Zorgblat or kim@zz.org.")] * 3
    d = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.disclosures(d, pii.find_base(d)).collect()
    assert {r.term: r.disclosure for r in found} == {"ask": 1.0, "zorgblat": 0.5}


def test_pii_odd_rows(spark):
    assert pii.report(odd_rows(spark)).count() == 7 and pii.report(odd_rows(spark).where("false")).count() == 0
    same = {(r.doc_id, r.text, r["_key"]) for r in odd_rows(spark).collect()}
    assert {(r.doc_id, r.text, r["_key"]) for r in pii.sanitise(odd_rows(spark)).collect()} == same


# ------------------------------------------------------------------ components

@pytest.mark.parametrize("per_task", [500_000, 9])
def test_components(spark, per_task):
    rnd = random.Random(6)
    edges = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(1000 + i, 1001 + i) for i in range(30)] + [(5000, 6000 + i) for i in range(30)]
    comp = {}
    for a, b in edges:
        joint = comp.get(a, {a}) | comp.get(b, {b})
        comp.update((x, joint) for x in joint)
    got = dict(tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long"), per_task).collect())
    assert got == {x: min(c) for x, c in comp.items() if len(c) > 1}


def test_marks_inside_a_line_end_no_sentence(spark):
    nav = "\n".join(f"products offers shop{i}.com basket account help{i}" for i in range(30))
    quoted = "\n".join(f'He{i} said{i} to{i} her{i} that{i} the{i} door{i} was{i} open{i} ("at{i} last.")' for i in range(12))
    loud = "\n".join(f"THIS{i} LINE{i} IS{i} ALL{i} IN{i} CAPITAL{i} LETTERS{i} AND{i} ENDS." for i in range(12))
    rows = spark.createDataFrame([(1, nav), (2, quoted), (3, loud)], "doc_id long, text string")
    got = {r.doc_id: r for r in quality_rules.quality_report(rows).collect()}
    assert not any(r.base_failed for r in got.values())
    assert (got[1].kept, got[2].kept, got[3].kept) == (False, True, False)
    assert got[1].n_words_removed == got[1].n_words and got[2].n_words_removed == 0


def test_fingerprints_of_rows_that_share_an_id(spark):
    rows = [(None, "a " * 400 + "end"), (None, "short text"), (7, "one two three"), (7, "four five six seven"), (7, "one two three"), (9, "")]
    got = fingerprints.fingerprint_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(r.n_chars for r in got) == sorted(len(t) for _, t in rows)
    assert len({r.fingerprint for r in got if r.doc_id is None}) == 2
    twice = [r for r in got if r.n_chars == 13]
    assert len(twice) == 2 and twice[0] == twice[1]
    ends = {t + n[:len(t) // 4] if len(t) < 4 else t[:len(t) - len(t) // 4] + n[:len(t) // 4] for _, t in rows for _, n in rows}
    assert {r.edited_sha256 for r in got} <= {sha(e.encode()) for e in ends}


def test_ftrl_equals_a_scalar_one():
    """The learner against FTRL-proximal written per coordinate with plain numbers."""
    rnd = random.Random(8)
    rows = [sorted(rnd.sample(range(60), rnd.randint(1, 12))) for _ in range(400)]
    labels = [int(len({3, 7, 11} & set(r)) > 0 or rnd.random() < 0.1) for r in rows]
    own = toxicity.Ftrl()
    own.learn([np.array(r) for r in rows], np.array(labels))
    z, n = defaultdict(float), defaultdict(float)
    a, b, l1, l2 = toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2

    def weight(i):
        if i != "bias" and abs(z[i]) <= l1:
            return 0.0
        shrunk = z[i] - (0 if i == "bias" else math.copysign(l1, z[i]))
        return -shrunk / ((b + math.sqrt(n[i])) / a + l2)

    for r, y in zip(rows, labels):
        w = {i: weight(i) for i in [*r, "bias"]}
        p = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values())))))
        for i in w:
            g = p - y
            sigma = (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / a
            z[i] += g - sigma * w[i]
            n[i] += g * g
    got = own.weights(np.arange(60))
    assert np.allclose(got, [weight(i) for i in range(60)]) and math.isclose(own.bias(), weight("bias"))
    assert (got == 0).any() and (got[[3, 7, 11]] > 0).all()


def test_toxicity_of_very_long_and_empty_texts_with_a_model(spark):
    rows = [(i, "fine words here " * 5 + ("dolt oaf" if i % 3 == 0 else "calm kind")) for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(300)], "doc_id long, toxic int")
    odd = [(1000, "fine words here " * 40000 + "dolt oaf"), (1001, "calm kind " * 60000), (1002, None), (1003, ""), (None, "dolt oaf")]
    got = {r.doc_id: r for r in toxicity.toxicity_report(spark.createDataFrame(rows + odd, "doc_id long, text string"), labels).collect()}
    assert got[1002].score == got[1003].score and got[1000].score > got[1001].score and got[None].predicted == 1 and not got[None].held_out
