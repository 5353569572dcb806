"""What the session helpers refuse and clean up."""

from types import SimpleNamespace

import pytest

from gleanery import session


def asking(master, named=None):
    made = []
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: named, setCheckpointDir=made.append)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=context), made


def test_no_local_folder_on_a_cluster():
    spark, made = asking("spark://host:7077")
    with pytest.raises(RuntimeError):
        session.shared_folder(spark)
    assert not made
    assert session.shared_folder(asking("spark://host:7077", "hdfs://shared")[0]) == "hdfs://shared"
    spark, made = asking("local[2]")
    assert session.shared_folder(spark) == made[0]


def test_a_missing_module_of_others_is_an_error(monkeypatch):
    import builtins

    import __spark_entry__ as entry

    real = builtins.__import__

    def without(missing):
        def load(name, *args, **kwargs):
            if name.startswith("gleanery.llm"):
                raise ModuleNotFoundError(f"No module named {missing!r}", name=missing)
            return real(name, *args, **kwargs)

        return load

    monkeypatch.setattr(builtins, "__import__", without("gleanery.llm"))
    assert entry._llm() == ({}, {})
    monkeypatch.setattr(builtins, "__import__", without("regex"))
    with pytest.raises(ModuleNotFoundError):
        entry._llm()
