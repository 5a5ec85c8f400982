"""Reproduce the hot-document measurement quoted in the README.

Every document of the given tables becomes one page of a single document, so
one key holds every line.  Segmentation is timed with the default line chunk
and with a single chunk (the plain per-document window), and the results are
compared.  Usage: python tools/hot_document.py [sf_dir]
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from lectern.operators import segment as SEG  # noqa: E402
from lectern.plans.tables import table  # noqa: E402
from lectern.plans.text_queries import DOC_RULES  # noqa: E402
from lectern.session import build_session  # noqa: E402


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session(shuffle_partitions=16)
    docs = table(spark, sf, "documents")
    pages = docs.select(F.lit(0).cast("bigint").alias("doc_id"), F.col("doc_id").cast("int").alias("page_no"),
                        F.concat("text", F.lit("\n")).alias("text"))
    results = {}
    for chunk in (SEG.LINE_CHUNK, 1 << 40):
        cls = SEG.classify_lines(SEG.page_lines(pages), DOC_RULES, line_chunk=chunk)
        times = []
        for _ in range(2):
            t = time.perf_counter()
            cls.write.format("noop").mode("overwrite").save()
            times.append(round(time.perf_counter() - t, 2))
        segs = SEG.segments(cls)
        results[chunk] = sorted(map(tuple, SEG.items_of(segs).collect()))
        print(f"line_chunk={chunk}: classification {times} s, items {len(results[chunk])}")
    a, b = results.values()
    print("same items:", a == b)


if __name__ == "__main__":
    main()
