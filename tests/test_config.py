import pytest

from sievework.config import ConfigError, Settings, load_settings, settings_from


def test_defaults_and_overrides(tmp_path):
    file = tmp_path / "c.yaml"
    file.write_text("")
    assert load_settings(file) == Settings()
    file.write_text("gopher:\n  min_words: 3\nlanguage:\n  target_langs: [de]\n  min_confidence: 1\n")
    got = load_settings(str(file))
    assert got.gopher.min_words == 3 and got.language.target_langs == ("de",) and got.language.min_confidence == 1.0 and got.gopher.max_words == 20000
    assert Settings().dedup.num_perm == 128 and ".pdf" in Settings().url_filter.drop_extensions


@pytest.mark.parametrize("text", ["nope: 1", "gopher: {min_word: 1}", "gopher: {min_words: x}", "gopher: 3", "pii: {mode: hide}", "fetch: {max_retries: true}", "url_filter: {deny_domains: a}", "gopher: {min_words: 1}\ngopher: {max_words: 2}", "a: ["])
def test_errors_name_the_file(tmp_path, text):
    file = tmp_path / "bad.yaml"
    file.write_text(text)
    with pytest.raises(ConfigError, match="bad.yaml"):
        load_settings(file)


def test_missing_file_and_unused_keys(tmp_path):
    with pytest.raises(FileNotFoundError):
        load_settings(tmp_path / "none.yaml")
    with pytest.warns(UserWarning, match="allow_mixed"):
        settings_from({"language": {"allow_mixed": True}})
