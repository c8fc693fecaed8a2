import json

from statuta.streaming import incremental as I

SCHEMA = "raw_id long, mst string, payload string"


def test_new_files_are_merged_once(spark, tmp_path):
    def add(raw_id, text):
        law = {"법령": {"조문": [{"조문번호": "1", "조문내용": text}]}}
        spark.createDataFrame([(raw_id, "7", json.dumps(law))], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def step():
        I.follow(spark, f"{tmp_path}/in", SCHEMA, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
        return sorted(r["text"] for r in I.current_units(spark, f"{tmp_path}/out").collect())

    add(1, "가")
    assert step() == ["가"]
    add(2, "가")
    add(3, "나")
    assert step() == ["가", "나"]
    assert step() == ["가", "나"]
