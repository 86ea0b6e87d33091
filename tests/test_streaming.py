from datetime import date

from rosterloom.sources import Source
from rosterloom.streaming import stage_arrivals


def test_each_arriving_file_is_staged_once(spark, tmp_path, contract):
    drop = tmp_path / "drop"
    drop.mkdir()

    def arrive(name, *lines):
        (drop / name).write_text("CHAPA;Data de Admissão\n" + "\n".join(lines) + "\n", encoding="utf-8")

    def stage():
        stage_arrivals(
            spark,
            Source(f"{drop}/*.csv"),
            ["CHAPA", "Data de Admissão"],
            contract,
            f"{tmp_path}/staged",
            f"{tmp_path}/checkpoint",
        )
        df = spark.read.parquet(f"{tmp_path}/staged")
        assert df.columns[: len(contract.names)] == contract.names
        return sorted(map(tuple, df.select("person_id", "hire_date", "_source_file").collect()))

    arrive("a 05-2026.csv", " 1 ;05/01/2026", " ; ")
    first = [("1", date(2026, 1, 5), "a 05-2026.csv")]
    assert stage() == first
    arrive("b.csv", "2;46027")
    assert stage() == [*first, ("2", date(2026, 1, 5), "b.csv")]
    assert stage() == [*first, ("2", date(2026, 1, 5), "b.csv")]
