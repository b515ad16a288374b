import pytest

from tessera.__main__ import main
from tessera.plans import settings


def test_precedence_and_ranges(tmp_path):
    f = tmp_path / "c.toml"
    f.write_text("[tessera]\ntarget = 0.7\nmin_conf = 0.5\nsize = 90\n")
    s = settings.load({"size": 64, "limit": None}, {"TESSERA_MIN_CONF": "0.6"}, str(f))
    assert (s.target, s.min_conf, s.size, s.limit, s.coarse_step) == (0.7, 0.6, 64, None, 5)
    assert settings.load({}, {}, str(tmp_path / "none.toml")) == settings.Settings()
    for bad in ({"target": 0}, {"coarse_step": 1}, {"size": 0}, {"dedup_min": 1.5}, {"nope": 1}, {"size": "x"}):
        with pytest.raises(ValueError):
            settings.load(bad, {})


def test_command_line(spark, tmp_path, capsys):
    assert main(["list"]) == 0 and "q01_manifest_diff" in capsys.readouterr().out
    assert main([]) == 2 and main(["run", "nope", "x"]) == 2 and main(["run", "q01_manifest_diff", str(tmp_path / "none")]) == 1
