"""Polygon texts: any white space, and a small file of many polygons is not one task's work."""

from geocadence.sources import tables as TB


def test_white_space_of_any_kind(spark):
    raw = spark.createDataFrame([("a", "POLYGON ((\t0 0,\n1\t 0 , 1 1,0 0 ),( 5 5\n,6 5, 5 6))"), ("b", "POLYGON ((x 1, 2))"), ("c", None)], "code string, wkt string")
    got = {r.alert_area_code: r.rings and [[tuple(v) for v in ring] for ring in r.rings] for r in TB.parse_polygons(raw.where("code <> 'b'"), "code").collect()}
    assert got == {"a": [[(0, 0), (1, 0), (1, 1)], [(5, 5), (6, 5), (5, 6)]], "c": None}


def test_texts_are_dealt_to_all_partitions(spark):
    raw = spark.range(1000).coalesce(1).selectExpr("cast(id as string) as code", "concat('POLYGON ((0 0, 1 0, 1 ', id, '))') as wkt")
    sizes = TB.parse_polygons(raw, "code").rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert sum(sizes) == 1000 and max(sizes) < 250
