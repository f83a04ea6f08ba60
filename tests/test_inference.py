from datetime import datetime

import pytest

from stayline.sources.inference import infer_types, read_inferred_csv


def write(tmp_path, *parts):
    for i, text in enumerate(parts):
        (tmp_path / f"part-{i}.csv").write_text(text)
    return str(tmp_path)


def kinds(types):
    return {f.name: f.dataType.simpleString() for f in types}


def test_types_and_values(spark, tmp_path):
    path = write(
        tmp_path,
        "i,d,t,s,na,big,mixed,quoted\n1,2,2024-01-31,x,NA,99999999999999999999,2024-01-01,\"a,b\"\n",
        "i,d,t,s,na,big,mixed,quoted\n -7 ,1e-3,2024-02-01 10:20:30.5, ,,3,4,\nNA,.5,,1d,null,,,c\n",
    )
    extract = read_inferred_csv(spark, path)
    assert kinds(extract.types) == {
        "i": "bigint", "d": "double", "t": "timestamp_ntz", "s": "string", "na": "string", "big": "double",
        "mixed": "string", "quoted": "string",
    }
    assert extract.rows.schema == extract.types and extract.rejected.count() == 0
    rows = sorted((tuple(r) for r in extract.rows.collect()), key=lambda r: r[1])
    assert rows == [
        (-7, 0.001, datetime(2024, 2, 1, 10, 20, 30, 500000), " ", None, 3.0, "4", None),
        (None, 0.5, None, "1d", None, None, None, "c"),
        (1, 2.0, datetime(2024, 1, 31), "x", None, 1e20, "2024-01-01", "a,b"),
    ]


def test_planted_bad_lines(spark, tmp_path):
    good = "".join(f"{i},{i}.5\n" for i in range(60))
    path = write(tmp_path, "a,b\n" + good + "1\n2,3,4\nsix,7\n8,?\nten,?\n")
    strict = read_inferred_csv(spark, path)
    assert kinds(strict.types) == {"a": "string", "b": "string"}
    assert sorted(r["line"] for r in strict.rejected.collect()) == ["1", "2,3,4"]
    assert strict.rows.count() == 63
    lenient = read_inferred_csv(spark, path, tolerance=0.05)
    assert kinds(lenient.types) == {"a": "bigint", "b": "double"}
    found = {(r["fields"]["a"], tuple(r["reasons"])) for r in lenient.rejected.collect()}
    assert found == {("1", ("fields",)), ("2", ("fields",)), ("six", ("a",)), ("8", ("b",)), ("ten", ("a", "b"))}
    assert lenient.rows.count() == 60
    # Lines are judged by all their fields, whatever is asked for.
    assert lenient.rejected.select("reasons").where("reasons[0] = 'fields'").count() == 2


def test_one_bad_value_over_the_tolerance_widens(make):
    texts = make([(str(i),) for i in range(19)] + [("x",)], "a string")
    assert kinds(infer_types(texts, ["a"], 0.05)) == {"a": "bigint"}
    assert kinds(infer_types(texts, ["a"], 0.049)) == {"a": "string"}


def test_empty_inputs(spark, make, tmp_path):
    extract = read_inferred_csv(spark, write(tmp_path, "a,b\n"))
    assert extract.rows.columns == ["a", "b"] and extract.rows.count() == extract.rejected.count() == 0
    assert not infer_types(make([], "a string"), []).fields


def test_clashing_internal_name(spark, tmp_path):
    with pytest.raises(ValueError):
        read_inferred_csv(spark, write(tmp_path, "_broken_line,b\n1,2\n"))
    other = tmp_path / "other"
    other.mkdir()
    extract = read_inferred_csv(spark, write(other, "reasons,line,fields,a.b\n1,2,3,4\n5\n"))
    assert extract.rows.collect()[0] == (1, 2, 3, 4) and extract.rejected.count() == 1
