"""Lattice encoding, quotation linking, the pipeline."""

import math
from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from sparecost.llm import chat, lattice

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def viterbi(text, pieces, sp):
    text = "▁" + text.replace(" ", "▁")
    low = min(s for _, s in pieces.values()) - 10
    best = [(0.0, -1, -1)] + [(-math.inf, -1, -1)] * len(text)
    for e in range(1, len(text) + 1):
        for s in range(max(0, e - 16), e):
            known = pieces.get(text[s:e])
            if known is None and e - s > 1:
                continue
            i, score = known or (-1, low)
            if best[s][0] + score > best[e][0]:
                best[e] = (best[s][0] + score, s, i)
    ids, e = [], len(text)
    while e:
        _, s, i = best[e]
        ids = ([i] if i >= 0 else [3 + b for b in text[s:e].encode()]) + ids
        e = s
    return ids


def test_lattice_matches_viterbi_and_round_trips(spark, docs, texts):
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=MODEL)
    table, about = lattice.piece_table(spark, MODEL)
    pieces = {r.piece: (r.id, r.score) for r in table.collect()}
    assert about["longest"] == 16 and about["byte"] == 3
    short = [(i, t) for i, t in texts if len(t or "") < 3000]
    given = docs.filter(F.length(F.coalesce("text", F.lit(""))) < 3000)
    found = {r.doc_id: r.ids for r in lattice.whole_texts(lattice.encoded_words(given, MODEL, block_bytes=4000)).collect()}
    for i, t in short:
        assert list(found[i] or []) == (viterbi(t, pieces, sp) if t else []), i
    checked = lattice.sentencepiece_check(docs, MODEL, block_bytes=20000).collect()
    assert len(checked) == len(texts) and all(r.round_trip for r in checked)


def test_lattice_returns_every_row(spark, docs, texts):
    """Copies of a row, also an odd and an even number of them, have the figures of the row alone."""
    rows = [t for t in texts if len(t[1] or "") < 1500]
    more = rows + rows[3:9] + rows[5:12] * 2 + [(None, "same text"), (None, "same text")]
    alone = {r.doc_id: tuple(r) for r in lattice.sentencepiece_check(spark.createDataFrame(rows, "doc_id long, text string"), MODEL, block_bytes=4000).collect()}
    found = lattice.sentencepiece_check(spark.createDataFrame(more, "doc_id long, text string").repartition(3), MODEL, block_bytes=4000).collect()
    assert Counter(r.doc_id for r in found) == Counter(i for i, _ in more)
    assert all(tuple(r) == alone[r.doc_id] for r in found if r.doc_id is not None)


def test_texts_are_shuffled_once(spark, docs):
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    try:
        words = lattice.encoded_words(docs, MODEL, block_bytes=4000)
        words.collect()
        plan = words._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
    assert plan.count("ReusedExchange") == 1 and "hashpartitioning(word" not in plan


def test_texts_are_encoded_where_they_are(spark, texts, monkeypatch):
    """The check shuffles nothing; blocks and steps of any size give the ids of the words, also of a long one."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=MODEL)
    pieces = {r.piece: (r.id, r.score) for r in lattice.piece_table(spark, MODEL)[0].collect()}
    given = [t for t in texts if len(t[1] or "") < 1500] + [(300, "ab" * 3000), (301, "  two  漢字 😀é\n "), (None, "a b")]
    df = spark.createDataFrame(given, "doc_id long, text string")
    for block in (60, 1 << 20):
        words = lattice.encoded_texts(df, MODEL, block_bytes=block)
        assert "Exchange" not in words._jdf.queryExecution().executedPlan().toString()
        found = words.collect()
        assert [r.doc_id for r in found] == [i for i, _ in given]
        for r, (_, text) in zip(found, given):
            assert "".join(r.words) == ("▁" + text.replace(" ", "▁") if text else "") and len(r.words) == len(r.ids)
            assert sum(r.ids, []) == (viterbi(text, pieces, sp) if text else [])
    whole = lattice.Lattice(MODEL)
    some = ["▁" + w for w in given[-3][1:] + tuple(given[8][1].split())]
    expected = whole.encode(some).to_pylist()
    monkeypatch.setattr(lattice, "_LETTERS", 7)
    assert whole.encode(some).to_pylist() == expected and whole.encode([]).to_pylist() == []


def test_lattice_empty(nothing, no_ids):
    assert lattice.sentencepiece_check(nothing, MODEL).count() == 0
    assert {(r.n_pieces > 0) for r in lattice.sentencepiece_check(no_ids, MODEL).collect()} == {True, False}


MESSAGES = [
    (1, 0, "user", "Where is the Red door?\n\nSecond paragraph."), (1, 1, "user", "Unrelated."),
    (1, 2, "assistant", "> where is  the red door?\nBehind you."), (1, 3, "user", "> > Where is the red door?\n> Behind you.\nI see it."),
    (1, 4, "user", "> nobody said this\nHm."), (1, 5, "user", None), (2, 0, "user", "> Behind you.\nother conversation"),
    (None, None, None, "x"), (3, 0, "user", "same"), (3, 0, "user", "same"), (3, 1, "user", ">same"), (3, 2, "user", ""),
]


def test_quotes(spark):
    df = spark.createDataFrame([(*m, 1) for m in MESSAGES], "conv_id long, turn long, role string, text string, h int")
    found = chat.link_quotes(df).collect()
    assert len(found) == len(MESSAGES)
    by = {(r.conv_id, r.turn): r for r in found}
    assert (by[1, 2].reply_to, by[1, 2].thread, by[1, 2].body, by[1, 2].n_quotes) == (0, 0, "Behind you.", 1)
    assert (by[1, 3].reply_to, by[1, 3].thread, by[1, 3].max_level, by[1, 3].body, by[1, 3].n_linked) == (2, 0, 2, "I see it.", 2)
    assert (by[1, 4].reply_to, by[1, 4].thread, by[1, 4].n_quotes, by[1, 4].n_linked) == (None, 4, 1, 0)
    assert (by[1, 1].reply_to, by[1, 1].body, by[1, 5].body) == (None, "Unrelated.", "")
    assert by[2, 0].reply_to is None and by[3, 1].reply_to == 0 and by[3, 1].body == ""
    assert chat.link_quotes(df.limit(0)).count() == 0


def test_parts_of_a_message_are_linked(spark):
    rows = [(1, 0, "user", "One line.\nSecond  line\n\nThird."), (1, 1, "user", "x"), (1, 2, "user", "> second line\nYes."), (1, 3, "user", "> Second line\n> third.\nNo."),
            (1, 4, "user", "> One line. Third.\nHm."), (1, 5, "user", "\n".join(f"> l{i}" for i in range(12)) + "\nlate"), (1, 6, "user", "\n".join(f"l{i}" for i in range(12))),
            (1, 7, "user", "\n".join(f"> l{i}" for i in range(12)) + "\nend")]
    found = {r.turn: r.reply_to for r in chat.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert found == {0: None, 1: None, 2: 0, 3: 0, 4: None, 5: None, 6: None, 7: 6}


def test_rendered_quotes_are_found_again(spark):
    """Replies and own words against the truth that the mails were made from, on a whole table."""
    given = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    mails = chat.render_quotes(given).cache()
    found = chat.link_quotes(mails).collect()
    assert len(found) == given.count()
    text = {(r.conv_id, r.turn): (r.text or "").strip() for r in given.collect()}
    replies = [r for r in found if text.get((r.conv_id, r.turn - 1))]
    assert len(replies) > 300 and all(r.n_quotes for r in replies)
    right = sum(r.reply_to == r.turn - 1 for r in replies)
    assert right >= 0.95 * len(replies)
    assert all(r.body.strip() == text[r.conv_id, r.turn] for r in found)


def test_pipeline(spark, docs, labels, tmp_path):
    folder = str(tmp_path / "sf")
    docs.drop("__row").write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    given = spark.read.parquet(f"{folder}/documents.parquet")
    step = given
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, step, folder)
        assert out.columns == step.columns and out.count() <= step.count(), name
        path = str(tmp_path / name)
        out.write.parquet(path)
        step = spark.read.parquet(path)
    kept = {r.doc_id for r in step.collect()}
    assert kept and len([i for i in kept if 100 <= i < 120]) <= 1
    packed = corpus_pipeline.run(spark, folder)
    assert {r.doc_id for r in packed.collect()} == kept


def test_pipeline_keeps_rows_without_an_own_id(spark, docs, labels, tmp_path):
    """Null ids, shared ids and repeated rows through every stage: what must stay stays once, nothing is doubled."""
    folder = str(tmp_path / "sf")
    own = [" ".join(f"w{(i * 7919 + (500 + k) * 104729) % 100003}" for i in range(60)) for k in range(6)]
    rows = [(1, own[0]), (1, own[1]), (None, own[2]), (None, own[3]), (2, own[4]), (2, own[4]), (None, own[4]), (3, own[5]), (3, own[5].upper()), (4, None), (None, None)]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        f"{folder}/documents.parquet")
    labels.limit(0).write.parquet(f"{folder}/labels.parquet")
    step = spark.read.parquet(f"{folder}/documents.parquet")
    sizes = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, folder)
        path = str(tmp_path / name)
        step.write.parquet(path)
        step = spark.read.parquet(path)
        sizes.append(step.count())
    assert sizes == [9, 6, 6, 6]
    found = step.collect()
    assert sorted(r.text.lower() for r in found) == sorted(own)
    assert sorted((r.doc_id or 0) for r in found) == [0, 0, 1, 1, 2, 3] or sorted((r.doc_id or 0) for r in found) == [0, 0, 0, 1, 1, 3]
    packed = corpus_pipeline.run(spark, folder).collect()
    assert len(packed) == 6


def test_pipeline_on_empty_tables(spark, docs, labels, tmp_path):
    folder = str(tmp_path / "sf")
    docs.drop("__row").limit(0).write.parquet(f"{folder}/documents.parquet")
    labels.limit(0).write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_all_lines_of_a_long_passage_are_compared(spark):
    """A message with the same first lines and another end does not say a passage; one that says it in its middle does."""
    lines = [f"l{i}" for i in range(20)]
    quoted = "\n".join(f"> {x}" for x in lines[:15])
    rows = [(1, 0, "user", "\n".join([*lines[:14], "other"])), (1, 1, "user", "\n".join(["start", *lines])), (1, 2, "user", quoted + "\nYes."),
            (1, 3, "user", "\n".join(f"> {x}" for x in [*lines[:9], "nobody"])), (2, 0, "user", "\n".join(lines)), (None, 1, "user", quoted), (1, 1, "user", "again")]
    found = chat.link_quotes(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(found) == len(rows)
    assert {(r.conv_id, r.turn): (r.reply_to, r.n_linked) for r in found if r.turn in (2, 3)} == {(1, 2): (1, 1), (1, 3): (None, 0)}
