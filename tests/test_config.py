import pytest

from loomstep import config as C

DOCUMENT = {"run": "a", "out": "${root}/${run}", "framework": {"action_model": {"future_action_window_size": 7, "hidden_size": 64, "diffusion_model_cfg": {"steps": 4}}, "qwenvl": {"vl_hidden_dim": 128}}}


def test_dotlist():
    assert C.dotlist(["--a.b", "1", "stray", "--flag", "--c=2", "--last"]) == ["a.b=1", "flag=true", "c=2", "last=true"]
    assert C.dotlist([]) == []


def test_overrides():
    got = C.overridden(DOCUMENT, ["framework.action_model.diffusion_model_cfg.steps=6", "x.y=false", "x.y=true", "z=[1, 2]", "n=null", "t=a=b"])
    assert got["framework"]["action_model"]["diffusion_model_cfg"]["steps"] == 6 and DOCUMENT["framework"]["action_model"]["diffusion_model_cfg"]["steps"] == 4
    assert got["x"] == {"y": True} and got["z"] == [1, 2] and got["n"] is None and got["t"] == "a=b" and got["out"] == "${root}/${run}"
    assert C.overridden(DOCUMENT) == C.overridden(DOCUMENT, []) == C.overridden(DOCUMENT, ()) == DOCUMENT
    for wrong in ("a=b", ""):
        with pytest.raises(TypeError, match="sequence of KEY=VALUE strings"):
            C.overridden(DOCUMENT, wrong)
    with pytest.raises(TypeError):
        C.overridden(DOCUMENT, [3])
    with pytest.raises(ValueError, match="Expected KEY=VALUE"):
        C.overridden(DOCUMENT, ["a.b"])


def test_upgrade():
    got = C.upgraded(DOCUMENT)
    model = got["framework"]["action_model"]
    assert model["action_horizon"] == 8 and model["past_action_window_size"] == 0 and model["action_hidden_dim"] == 64
    assert model["diffusion_model_cfg"] == {"steps": 4, "output_dim": 64, "cross_attention_dim": 128} and got["version_id"] == C.VERSION
    assert C.upgraded(got) == got and C.upgraded(None) is None and "version_id" not in DOCUMENT
    assert C.upgraded({"framework": {"action_model": {"action_horizon": 5}}})["framework"]["action_model"]["future_action_window_size"] == 4
    odd, said = {"framework": {"action_model": {"action_horizon": 5, "future_action_window_size": 9}}}, []
    assert C.upgraded(odd, warn=said.append)["framework"]["action_model"]["future_action_window_size"] == 4 and len(said) == 1
    with pytest.raises(ValueError):
        C.upgraded(odd, strict=True)


def test_leaves():
    assert C.leaf_paths({"a", "a.b", "a.b[0]", "a.b[0].c", "ab", "d[1]", "d"}) == {"a.b[0].c", "ab", "d[1]"}
    assert C.leaf_paths([]) == set()


def test_keys_and_offsets():
    configs = {"state": {"keys": ["state.arm", "state.hand"], "offsets": [0]}, "action": {"keys": ["action.arm"], "offsets": [0, 1, 2]}}
    assert C.modality_keys(configs) == {"state": ["state.arm", "state.hand"], "action": ["action.arm"]}
    assert C.key_offsets(configs) == {"state.arm": [0], "state.hand": [0], "action.arm": [0, 1, 2]}


def test_sample_policy():
    got = C.SamplePolicy.of({"action_horizon": 8, "max_views": 2}, {"action_dim": 7, "action_horizon": 8, "state_dim": 9})
    assert (got.action_horizon, got.action_dim, got.state_dim, got.max_views, got.retry_bad_samples) == (8, 7, 9, 2, 20)
    assert C.SamplePolicy.of({"action_horizon": 8, "action_dim": 7, "include_state": "False"}, {"state_dim": 9}).state_dim is None
    with pytest.raises(ValueError, match="mismatch"):
        C.SamplePolicy.of({"action_horizon": 8, "action_dim": 7}, {"action_dim": 6})
    with pytest.raises(ValueError, match="needed"):
        C.SamplePolicy.of({"action_horizon": 8})


def test_contracts():
    C.check_server(3, {"ckpt_path": "x", "seed": 3})
    for wrong in (None, {"seed": 3}, {"ckpt_path": "x"}, {"ckpt_path": "x", "seed": 4}):
        with pytest.raises(ValueError):
            C.check_server(3, wrong)
    assert C.observation_faults([{"image": [(4, 4), (4, 4)]}] * 2, (4, 4)) == []
    assert len(C.observation_faults([{"image": [(4, 5)]}, {"image": [(4, 4)] * 2}, {}], (4, 4))) == 3
