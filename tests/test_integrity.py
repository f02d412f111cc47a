"""Integrity of the raw layer (G1-G3) on queue-envelope cases."""

from changeflow.operators import integrity


def _q(spark, rows):
    return spark.createDataFrame(rows, "particion string, desplazamiento string")


def test_null_partition_is_not_a_duplicate(spark):
    r = integrity.duplicate_count(_q(spark, [(None, "1"), (None, "2"), (None, "3")])).first()
    assert (r.filas, r.distintos, r.duplicados) == (3, 3, 0)


def test_duplicate_and_gap_in_one_partition(spark):
    rows = [("0", "0"), ("0", "1"), ("0", "1"), ("0", "3"), ("1", "5"), ("1", "6"), ("10", "0")]
    d = integrity.duplicate_count(_q(spark, rows)).first()
    assert d.duplicados == 1
    c = {r.particion: r for r in integrity.continuity(_q(spark, rows)).collect()}
    assert (c["0"].filas, c["0"].distintos, c["0"].primero, c["0"].ultimo, c["0"].huecos) == (4, 3, 0, 3, 1)
    assert c["1"].huecos == 0
    order = [r.particion for r in integrity.continuity(_q(spark, rows)).collect()]
    assert order == ["0", "1", "10"]
    v = integrity.verdict(_q(spark, rows)).first()
    assert (v.duplicados, v.huecos, v.ok) == (1, 1, False)


def test_non_contiguous_source_judged_on_duplicates(spark):
    rows = [(None, "49590338271490256608559692538361571095921575989136588898"),
            (None, "49590338271490256608559692540925702759324208523137515618")]
    v = integrity.verdict(_q(spark, rows), contiguous=False).first()
    assert v.ok and v.huecos is None


def test_missing_offset_gives_null_bounds(spark):
    c = integrity.continuity(_q(spark, [("0", None), ("0", "x")])).first()
    assert c.primero is None and c.filas == 2


def test_unreadable_offsets_are_no_proof(spark):
    for offsets in (["x", "y", "z"], ["1", "2", "?"], ["1", None]):
        df = spark.createDataFrame([("0", o) for o in offsets], "particion string, desplazamiento string")
        v = integrity.verdict(df).first()
        assert not v.ok and v.ilegibles == sum(not (o or "").isdigit() for o in offsets)
        assert integrity.verdict(df, contiguous=False).first().ok


def test_bitmaps_equal_counting_and_find_every_gap(spark):
    import random
    rnd = random.Random(5)
    rows = []
    for part, lo, hi in (("0", 0, 200_000), ("1", 32_700, 32_800), ("2", -70_000, 70_000), ("3", 10**15, 10**15 + 90_000), (None, 5, 9)):
        here = set(range(lo, hi))
        for _ in range(40):
            at = rnd.randrange(lo, hi)
            here -= set(range(at, at + rnd.choice([1, 2, 30, 40_000])))
        here |= {lo, hi}
        rows += [(part, str(o)) for o in here] + [(part, str(lo))]
    rows += [("0", "x"), ("0", None), ("4", "y")]
    q = _q(spark, rows).repartition(4)
    bitmaps = integrity.offset_bitmaps(q)
    key = lambda r: str(r.particion)
    plain = sorted(integrity.continuity(q).collect(), key=key)
    assert sorted(integrity.continuity_from_bitmaps(bitmaps).select(integrity.continuity(q).columns).collect(), key=key) == plain
    gaps = {}
    for r in integrity.gap_ranges(bitmaps).collect():
        assert r.faltan == r.hasta - r.desde + 1
        gaps.setdefault(r.particion, []).append((r.desde, r.hasta))
    have = {}
    for p, o in rows:
        if o and o.lstrip("-").isdigit():
            have.setdefault(p, set()).add(int(o))
    for p, offsets in have.items():
        order = sorted(offsets)
        assert sorted(gaps.get(p, [])) == [(a + 1, b - 1) for a, b in zip(order, order[1:]) if b > a + 1]
    assert any(b - a > 32_768 for a, b in gaps["0"])


def test_bitmap_verdict(spark):
    cases = [[("0", "0"), ("0", "1")], [("0", "0"), ("0", "1"), ("0", "1")], [("0", "0"), ("0", "2")], [("0", "0"), ("0", "?")]]
    for rows in cases:
        q = _q(spark, rows)
        a, b = integrity.verdict(q).first(), integrity.verdict_from_bitmaps(integrity.offset_bitmaps(q)).first()
        assert a.ok == b.ok and (a.filas, a.duplicados, a.huecos, a.ilegibles) == (b.filas, b.duplicados, b.huecos, b.ilegibles)
    odd = integrity.offset_bitmaps(_q(spark, [("0", "7"), ("0", "007")])).first()
    assert odd.raros == 1


def test_two_origins_are_two_queues(spark):
    rows = [("a", "0", str(i)) for i in range(5)] + [("b", "0", str(i)) for i in range(90, 95)]
    q = spark.createDataFrame(rows, "origen string, particion string, desplazamiento string")
    assert integrity.verdict_from_bitmaps(integrity.offset_bitmaps(q)).first().huecos == 85
    both = ("origen", "particion")
    assert integrity.verdict_from_bitmaps(integrity.offset_bitmaps(q, both), both).first().ok
