from textfeat.operators import weights
from textfeat.plans import runs
from textfeat.streaming import frequency


def test_stopped_run_is_taken_up(spark, tmp_path):
    source, state, checkpoint = (str(tmp_path / d) for d in ("docs", "state", "checkpoint"))
    docs = [(i, f"a w{i % 4} --") for i in range(20)]
    schema = "doc_id long, body string"

    def arrive(part):
        spark.createDataFrame(part, schema).write.mode("append").parquet(source)

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        frequency.maintain_state(stream, state, checkpoint).awaitTermination()
        merged = weights.merge_states(frequency.read_state(spark, state))
        return {r.word: r.df for r in merged.collect()}

    arrive(docs[:7])
    assert run() == {r.word: r.df for r in runs.frequency_state(spark.createDataFrame(docs[:7], schema)).collect()}
    assert run()["a"] == 7  # nothing new, nothing counted again
    arrive(docs[7:])
    assert run() == {r.word: r.df for r in runs.frequency_state(spark.createDataFrame(docs, schema)).collect()}


def test_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "state")
    docs = spark.createDataFrame([(1, "a b", 0), (2, "a", 1)], "doc_id long, body string, batch long")
    states = runs.frequency_state(docs, keys=["batch"])
    frequency.write_states(states, path)
    frequency.write_states(states.where("batch = 1"), path)
    merged = weights.merge_states(frequency.read_state(spark, path))
    assert {r.word: r.df for r in merged.collect()} == {"a": 2, "b": 1, None: 2}
