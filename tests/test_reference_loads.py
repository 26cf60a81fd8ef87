import pytest

from costledger.schemas import REFERENCE
from costledger.sinks import reference as ref


def load(spark, codes):
    return spark.createDataFrame([(c, f"s{c}", "A", "B", "a@b.c") for c in codes], REFERENCE)


def test_codes_are_unique_over_loads(spark, tmp_path):
    path = str(tmp_path / "reference")
    assert ref.append_reference(load(spark, ["0000001", "0000002"]), path, "one")
    assert not ref.append_reference(load(spark, ["0000001", "0000002"]), path, "one")  # tried again
    with pytest.raises(ValueError, match="not unique: 0000002$"):
        ref.append_reference(load(spark, ["0000003", "0000002"]), path, "two")
    with pytest.raises(ValueError, match="not unique: 0000004$"):
        ref.append_reference(load(spark, ["0000004", "0000004"]), path, "three")
    assert ref.append_reference(load(spark, ["0000003", None, None]), path, "two")
    assert sorted(str(r["tr_code"]) for r in ref.read_reference(spark, path).collect()) == ["0000001", "0000002", "0000003", "None", "None"]


def test_only_touched_buckets_are_read(spark, tmp_path, capsys):
    path = str(tmp_path / "reference")
    ref.append_reference(load(spark, [f"{i:07d}" for i in range(500)]), path, "one")
    found = ref.stored_codes(load(spark, ["0000007", "9999999"]), path)
    assert [r["tr_code"] for r in found.collect()] == ["0000007"]
    found.explain("formatted")
    plan = capsys.readouterr().out
    scan = next(part for part in plan.split("\n\n") if "PartitionFilters" in part and "bucket" in part)
    assert "ReadSchema: struct<tr_code:string>" in scan and "IN" in scan.upper()
