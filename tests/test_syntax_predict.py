from cmdeval.operators import predict, prep, syntax

VALID = ["", "docker ps", "docker system health", "kill -9 $(lsof -t -i:3000)", "# c", "<<EOF"]
INVALID = ["echo 'x", "a && ", "a || ", "if true", "((", "echo $(", "for i in 1 2; do echo $i", "-foo", "+n"]


def test_parse_outcomes():
    for c in VALID:
        assert syntax.parse_outcome(c) == syntax.ACCEPTED, c
    for c in INVALID:
        assert syntax.parse_outcome(c) == syntax.REJECTED, c
    assert syntax.parse_outcome("echo a\x00b") == syntax.NOT_RUN
    assert syntax.parse_outcome("echo " + "x" * 300_000) == syntax.ACCEPTED


def test_check_joins_back_every_row(spark):
    cmds = VALID + INVALID + ["docker ps"] * 5 + [None]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cmds)], "id int, cmd string")
    got = {r.id: r.ok for r in syntax.attach(df, syntax.verdicts(df, "cmd", "ok"), "cmd", "ok").collect()}
    assert len(got) == len(cmds)
    for i, c in enumerate(cmds):
        assert got[i] == (c is not None and c in VALID), c


def test_batch_predict_errors_become_blank(spark):
    df = spark.createDataFrame([(i, f"q{i}") for i in range(20)], "id int, instruction string")
    prompts = prep.render_prompt(df)

    def make():
        def answer(batch):
            if any("q13" in p for p in batch):
                raise RuntimeError("down")
            return [" ls -la \n" for _ in batch]
        return answer

    out = {r.id: r for r in predict.run(prompts, make, batch_size=1).collect()}
    assert out[13].raw_prediction == "" and out[13].latency == 0.0 and out[13].is_error
    assert out[0].raw_prediction == "ls -la" and not out[0].is_error and out[0].latency >= 0.0


def test_echo_predictor():
    f = predict.echo_user_predictor()
    assert f(["<|im_start|>user\nlist files\nplease<|im_end|>\n<|im_start|>assistant\n"]) == ["list files"]


def test_many_commands_share_a_shell(monkeypatch):
    odd = ["[[ >", "cat <<EOF", "a=( <<- \n exit ] done", "set +n", "exit", "-", "--help", "+O", "\x01 ]] if while",
           "echo '\x7f", "echo a\x00b", "[[ a == b ]]", "{ " * 5_000, "x" * 200_000 + "'", "-x" * 60_000]
    cmds = (VALID + INVALID + odd) * 3
    alone = [syntax.parse_outcome(c) for c in cmds]
    assert syntax.parse_outcomes(cmds) == alone
    started = []
    real = syntax.subprocess.Popen
    monkeypatch.setattr(syntax.subprocess, "Popen", lambda *a, **k: started.append(a) or real(*a, **k))
    assert syntax.parse_outcomes([f"echo {i}" for i in range(256)]) == [syntax.ACCEPTED] * 256
    assert len(started) == 1


def test_a_command_that_holds_the_shell_up_is_parsed_alone(monkeypatch):
    # A shell that stops after two digits, as one held up by its third command would.
    monkeypatch.setattr(syntax, "PARSER", "printf 1; printf 0; sleep 30")
    alone = []
    monkeypatch.setattr(syntax, "parse_outcome", lambda c, *_: alone.append(c) or syntax.TIMED_OUT)
    got = syntax.parse_outcomes(["a", "b", "c", "d", "e"], timeout=0.2)
    assert got == [syntax.ACCEPTED, syntax.REJECTED, syntax.TIMED_OUT, syntax.ACCEPTED, syntax.REJECTED]
    assert alone == ["c"]


def test_nothing_of_a_command_is_run(tmp_path):
    spot = tmp_path / "made"
    cmds = [f"touch {spot}", f"set +n; touch {spot}", f"fi; touch {spot}; if true", f"}}; touch {spot}; f() {{",
            f"$(touch {spot})", f"\ntouch {spot}", f"'; touch {spot}", f"[[ -n $(touch {spot}) ]]"]
    syntax.parse_outcomes(cmds)
    assert not spot.exists()
