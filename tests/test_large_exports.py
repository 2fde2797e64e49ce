"""Documents read message by message, against the plain reader and the json module."""

import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from palaver.plans.ingest import ingest
from palaver.sources import exports
from palaver.sources.large_exports import BrokenDocument, MessageReader, read_large_exports
from palaver.sources.store import Store
from test_ingest import T1, check_two_loads, document, message, short, two_loads, unusable, values, write

T2 = T1.replace(day=2)


def read(text, cuts=()):
    """(messages, fields) of a document fed in pieces."""
    data, reader, out = text.encode("utf-8", "surrogatepass"), MessageReader(), []
    edges = [0, *sorted(c % (len(data) + 1) for c in cuts), len(data)]
    for a, b in zip(edges, edges[1:], strict=False):
        out += [json.loads(m) for m in reader.feed(data[a:b])]
    reader.close()
    return out, {k: json.loads(v) for k, v in reader.fields.items()}


values_of = st.recursive(
    st.none() | st.booleans() | st.integers() | st.text("ab\"\\{}[],: \n\té😀", max_size=8),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text("ab\"}{\\", max_size=3), inner, max_size=3),
    max_leaves=8,
)


@settings(max_examples=300, deadline=None)
@given(
    st.lists(st.dictionaries(st.text("ab\"}", max_size=3), values_of, max_size=4), max_size=6),
    st.dictionaries(st.sampled_from(["guild", "channel", "extra", "]}\""]), values_of, max_size=3),
    st.lists(st.integers(0, 10_000), max_size=8), st.booleans(), st.sampled_from([None, 1]), st.booleans(),
)
def test_reads_like_the_json_module(messages, fields, cuts, first, indent, ascii_only):
    whole = {"messages": messages, **fields} if first else {**fields, "messages": messages}
    text = json.dumps(whole, indent=indent, ensure_ascii=ascii_only) + "\n"
    assert read(text, cuts) == (messages, fields)
    data = text.rstrip()
    for end in {0, 1, len(data) // 2, len(data) - 1}:
        with pytest.raises(BrokenDocument):
            read(data[:end], cuts)


@pytest.mark.parametrize(
    "text",
    ["", "[]", "{", "}", "{}}", '{"a"}', '{"a":}', '{"a":1,}', '{,}', '{"messages":[1]}', '{"messages":{}}', '{"messages":[{},]}',
     '{"messages":[{}', '{"messages":[{}]} x', '{"messages":[{}{}]}', "{'a':1}", '{"a":tru}', '{"messages":[,{}]}', '{"a":1 "b":2}', '{"x":"\x01"}'],
)
def test_broken_documents(text):
    with pytest.raises(BrokenDocument):
        read(text)


def test_odd_but_whole_documents():
    assert read("{}") == ([], {})
    assert read(' { "messages" : [ ] , "a" : 1 } ') == ([], {"a": 1})
    assert read('{"messages":null}') == ([], {"messages": None})
    assert read('{"messages":[null, {"a":[]}]}') == ([None, {"a": []}], {})


def test_holds_one_message_at_a_time():
    reader, most = MessageReader(), 0
    one = json.dumps({"id": "1", "content": "x" * 500 + "}{\\\"" * 20}).encode()
    list(reader.feed(b'{"messages":['))
    for i in range(2000):
        found = list(reader.feed((b"," if i else b"") + one[:200]))
        most = max(most, len(reader._rest))
        found += list(reader.feed(one[200:]))
        assert len(found) == 1
        most = max(most, len(reader._rest))
    assert most <= len(one) + 1 and reader.count == 2000


def same(spark, path):
    documents, large = exports.read_exports(spark, path), read_large_exports(spark, path)
    plain = exports.file_rows(documents).drop("messages")
    assert large.files.schema == plain.schema
    assert sorted(map(repr, large.files.collect())) == sorted(map(repr, plain.collect()))
    rows = exports.explode_messages(documents)
    assert [f.name for f in large.messages.schema] == [f.name for f in rows.schema]
    assert sorted(map(repr, large.messages.collect())) == sorted(map(repr, rows.collect()))


def test_rows_equal_the_plain_reader(spark, tmp_path):
    rng = random.Random(4)
    odd = [message(i, content=rng.choice(["}", "a}b", '"}', "\\}", "{", "[]", "é😀", "\n", ""]) * rng.randint(0, 4), name="a}b") for i in range(80)]
    write(tmp_path / "in" / "deep", odd=document(*odd), none=document())
    (tmp_path / "in" / "pretty + 50%.json").write_text(json.dumps(document(*odd[:9]), indent=2) + "\n\n")
    unusable(tmp_path / "in")
    same(spark, str(tmp_path / "in"))
    same(spark, str(tmp_path / "in" / "pretty + 50%.json"))


def test_broken_tail_rejects_the_file(spark, tmp_path):
    """Also if the break is far behind many good messages, or the file ends right before its last brace."""
    good = json.dumps(document(*(message(i) for i in range(300))))
    cases = {"cut": good[: len(good) // 2], "brace": good[:-1], "tail": good + "x", "good": good, "empty": "", "space": " \n"}
    path = write(tmp_path / "in", **cases)
    large = read_large_exports(spark, path)
    errors = {short(r.file_path): r.error for r in large.files.collect()}
    assert errors == {f"{n}.json": None if n == "good" else "unreadable file" for n in cases if n != "empty"}
    assert {short(r.file_path) for r in large.messages.select("file_path").distinct().collect()} == {"good.json"}
    assert large.messages.count() == 300


def test_large_file_over_many_splits(spark, tmp_path):
    """A file of many times the split size: order and content are kept, and batches stay small."""
    many = [message(i, content=f"text {i} " + "}" * (i % 7) + "w" * (i % 400)) for i in range(30_000)]
    path = write(tmp_path / "in", big=document(*many), small=document(message(10**6)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        large = read_large_exports(spark, path)
        found = sorted((r.pos, r.id, r.content) for r in large.messages.filter("file_path like '%big.json'").select("pos", "message.id", "message.content").collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found == [(i, m["id"], m["content"]) for i, m in enumerate(many)]


def test_loads_into_the_store(spark, tmp_path):
    first, second = two_loads(tmp_path)
    store = Store(spark, str(tmp_path / "store"))
    stats = ingest(read_large_exports(spark, first), store, T1, "1").collect()
    assert sorted((short(r.file_path), r.new, r.updated) for r in stats) == [("a.json", 4, 0), ("b.json", 0, 1)]
    ingest(read_large_exports(spark, second), store, T2, "2")
    check_two_loads(store)
    assert values(store.table("messages"), "message_id")
