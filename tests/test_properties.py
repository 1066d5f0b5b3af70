"""Properties on many random inputs, each set checked in one Spark job."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from atlaslens.functions import geo
from atlaslens.functions.age import precision
from atlaslens.functions.bilingual import with_bilingual_texts
from atlaslens.operators import paging, reviews

T, O = "(T)", "(O)"


def expected_texts(parts):
    """The rule told step by step over one list."""
    parts = [p.strip() for p in parts if p.strip()]
    tagged = [i for i, p in enumerate(parts) if T in p]
    if not tagged:
        return (parts[0], parts[0]) if parts else ("", "")
    i = tagged[0]
    if parts[i] == T:
        after = parts[i + 1] if i + 1 < len(parts) else None
        before = "" if len(parts) == 1 else parts[-1] if i == 0 else parts[i - 1]
        return before, after
    rest = parts[i].replace(T, "").strip()
    if rest == "":
        return parts[0], parts[0]
    marked = [j for j, p in enumerate(parts) if O in p]
    if not marked:
        return "", rest
    j = marked[0]
    if parts[j] == O and j + 1 < len(parts):
        return parts[j + 1], rest
    return parts[j].replace(O, "").strip(), rest


def test_bilingual_texts(spark):
    rng = random.Random(5)
    words = [T, O, f"{T} t", f"{O} o", "a", "b", "  ", " \n", f" {T}\n", f"{T}{T}", f"{T} {O} x"]
    cases = [[rng.choice(words) for _ in range(rng.randrange(6))] for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(cases)), "i int, parts array<string>")
    got = with_bilingual_texts(df, F.col("parts"), F.lit(None).cast("string"), F.lit(T), F.lit(O))
    found = {r.i: (r.original, r.translated) for r in got.collect()}
    for i, parts in enumerate(cases):
        assert found[i] == expected_texts(parts), parts


def test_zip_is_as_long_as_the_longest_list(spark):
    rng = random.Random(6)
    some = lambda: None if rng.random() < 0.1 else [str(n) for n in range(rng.randrange(5))]
    cases = [(i, some(), some(), some()) for i in range(300)]
    df = spark.createDataFrame(cases, "i int, a array<string>, b array<string>, c array<string>")
    rows = reviews.zip_lists(df, {"a": "x", "b": "y", "c": "z"}).collect()
    for i, *lists in cases:
        mine = sorted((r for r in rows if r.i == i), key=lambda r: r.position)
        lists = [values or [] for values in lists]
        assert [r.position for r in mine] == list(range(max(map(len, lists))))
        assert [tuple(values[n] if n < len(values) else None for values in lists) for n in range(len(mine))] == [(r.x, r.y, r.z) for r in mine]
        assert [r.aligned for r in mine] == [n < len(lists[0]) for n in range(len(mine))]


def test_a_cell_lies_in_its_parent_and_holds_its_centre(spark):
    points = spark.range(5000).select((F.rand(1) * 170 - 85).alias("lat"), (F.rand(2) * 360 - 180).alias("lng"))
    cells = geo.with_location_cells(points, F.col("lat"), F.col("lng"))
    wrong = cells.where(geo.parent_cell(F.col("loc_cell_fine"), geo.FINE_LEVEL, geo.COARSE_LEVEL) != F.col("loc_cell_coarse"))
    assert wrong.isEmpty()
    children = geo.cover(cells.select(F.col("loc_cell_coarse").alias("cell")).distinct())
    assert children.count() == children.select("child_cell").distinct().count() == 64 * children.select("cell").distinct().count()
    again = geo.point_cell(F.col("centre_lat"), F.col("centre_lng"), geo.FINE_LEVEL)
    assert children.where(again != F.col("child_cell")).isEmpty()
    parent = geo.parent_cell(F.col("child_cell"), geo.FINE_LEVEL, geo.COARSE_LEVEL)
    assert children.where(parent != F.col("cell")).isEmpty()


def test_precision_grows_with_age(spark):
    values = [r.p for r in spark.range(1200).orderBy("id").select(precision(F.col("id")).alias("p")).collect()]
    assert values == sorted(values) and set(values) == {0, 1, 7, 30, 365}


def test_kept_pages_are_a_prefix(spark):
    rng = random.Random(8)
    rows = [(p, "en", n, rng.random() < 0.1) for p in range(200) for n in range(rng.randrange(1, 40))]
    df = spark.createDataFrame(rows, "place_id int, language string, page_number int, is_stop boolean")
    kept = paging.take_until_stop(df)
    found: dict[int, list] = {}
    for r in kept.collect():
        found.setdefault(r.place_id, []).append((r.page_number, r.is_stop))
    for place in range(200):
        pages = sorted(found[place])
        every = sorted((n, stop) for p, _, n, stop in rows if p == place)
        assert pages == every[:len(pages)]
        assert not any(stop for _, stop in pages[:-1])
        assert pages[-1][1] or len(pages) == len(every)
    # Stopping again changes nothing.
    assert paging.take_until_stop(kept).count() == kept.count()
