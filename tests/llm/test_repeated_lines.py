from __future__ import annotations

from collections import defaultdict

from veredas.llm.pages import visible_lines
from veredas.llm.repeated_lines import line_key, repeated_lines, strip_repeated_lines


def brute(rows, least_items, share):
    items, support, places = defaultdict(set), defaultdict(set), []
    for pos, source, item, text in rows:
        if source is None:
            continue
        if item is not None:
            items[source].add(item)
        for n, line in enumerate(visible_lines(text or ""), 1):
            key = line_key(line)
            if key is not None:
                places.append((pos, n, source, key))
                if item is not None:
                    support[source, key].add(item)
    return sorted((p, n) for p, n, s, k in places if len(support[s, k]) >= least_items and len(support[s, k]) >= share * len(items[s]))


SCHEMA = "pos long, source_id string, id string, raw_text string"


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", source string")
    return sorted((r.pos, r.line_no) for r in repeated_lines(df, **options).collect())


def test_hot_source_nulls_and_repeated_rows(spark):
    rows = [(i, "hot", f"i{i % 40}", f"<p>Síganos en redes {i}</p>\nnota propia {'abcdefghij'[i % 10]}{i}x{'z' * i}\n<script>\nno\n</script>\n12 34\n¡SÍGANOS en redes!") for i in range(60)]
    rows += [(100 + i, "cold", f"c{i}", "Aviso legal\n\ntexto") for i in range(9)]
    rows += [(200, None, "n", "Aviso legal"), (201, "hot", None, "siganos en redes"), (202, "hot", "i1", None), (203, "hot", "i2", ""), (204, "hot", "i3", "y" * 300_000)]
    want = brute(rows, 10, 0.1)
    assert found(spark, rows) == want and (201, 1) in want and not any(p >= 100 and p < 200 for p, _ in want)


def test_blocks_follow_neighbours(spark):
    rows = [(i, "s", f"i{i}", "uno de pie\n\ndos de pie\n" + "cuerpo " + "abcdefghijklmnop"[i] + "\nsuelto") for i in range(12)]
    df = spark.createDataFrame(rows, SCHEMA)
    blocks = {r.line_no: r.block for r in repeated_lines(df).collect()}
    assert set(blocks) == {1, 3, 5} and blocks[1] == blocks[3] != blocks[5]


def test_empty_table_and_stripping(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repeated_lines(empty).count() == 0
    rows = spark.createDataFrame([(1, "a\nb\nc", "old"), (2, None, "old"), (3, "d", "old")], "pos long, raw_text string, kept_text string")
    gone = spark.createDataFrame([(1, 2), (1, 2)], "pos long, line_no int")
    assert sorted((r.pos, r.kept_text) for r in strip_repeated_lines(rows, gone).collect()) == [(1, "a\nc"), (2, None), (3, "d")]
