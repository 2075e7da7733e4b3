"""Compare result column types of every key between Spark and DuckDB (no data compare)."""

import sys

sys.path.insert(0, __file__.rsplit("/", 2)[0])

from uptake.plans.catalog import REGISTRY  # noqa: E402
from uptake.session import local_session  # noqa: E402
from tests.oracle import duck  # noqa: E402

SPARK = {"IntegerType": "int32", "LongType": "int64", "DoubleType": "float64", "StringType": "string",
         "BooleanType": "bool", "DateType": "date", "TimestampNTZType": "timestamp", "TimestampType": "timestamp",
         "ShortType": "int16", "ByteType": "int8", "FloatType": "float32"}
DUCK = {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64", "VARCHAR": "string", "BOOLEAN": "bool",
        "DATE": "date", "TIMESTAMP": "timestamp", "SMALLINT": "int16", "TINYINT": "int8", "FLOAT": "float32",
        "HUGEINT": "int128"}


def cat_spark(t):
    n = type(t).__name__
    return f"decimal({t.precision},{t.scale})" if n == "DecimalType" else SPARK.get(n, n)


def cat_duck(t):
    s = str(t)
    return s.lower().replace("decimal", "decimal") if s.startswith("DECIMAL") else DUCK.get(s, s)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(4)
    con = duck(sf)
    bad = 0
    for key, (fn, sql) in REGISTRY.items():
        if sql is None:
            continue
        s = {f.name: cat_spark(f.dataType) for f in fn(spark, sf).schema.fields}
        rel = con.sql(sql)
        d = {c: cat_duck(t) for c, t in zip(rel.columns, rel.types)}
        diff = {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}
        if diff:
            bad += 1
            print(key, diff)
    print("keys with type differences:", bad)


if __name__ == "__main__":
    main()
