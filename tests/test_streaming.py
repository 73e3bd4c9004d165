from allelespan.functions import seq as S
from allelespan.operators import kmer
from allelespan.sources import staging
from allelespan.streaming import kmers


def test_stream_equals_batch(spark, tmp_path):
    rows = [("a", "ACGTTGCAAC"), ("b", "ACGTACGTAC"), ("c", "TTTTGCAACG")]
    for i, r in enumerate(rows):
        spark.createDataFrame([r], "name string, seq string").write.parquet(f"{tmp_path}/in/{i}")
    targets = S.kmers(spark.createDataFrame([("t", "ACGTTGCA")], "target string, seq string"), "seq", 4, "target").select("target", "kmer").distinct()
    stream = spark.readStream.schema("name string, seq string").option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    query = kmers.to_memory(kmers.target_counts(stream, targets, 4), "streamed")
    query.awaitTermination()
    batch = kmer.target_counts(S.kmers(spark.createDataFrame(rows, "name string, seq string"), "seq", 4), targets, "target")
    assert sorted(map(tuple, spark.table("streamed").collect())) == sorted(map(tuple, batch.collect()))


def test_staged_tables_are_cleared(spark):
    df = staging.staged(spark.range(5).toDF("x"), "test")
    assert df.count() == 5 and staging.clear(spark) >= 1 and staging.clear(spark) == 0
