import json
import os
import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pathweave.functions.shell import normalize_path, resolve_path, shell_words
from pathweave.operators import commands as C
from pathweave.sources import files


def words_by_state(text):
    """The words of a command line, one character at a time."""
    out, word, i, quote = [], None, 0, ""
    while i < len(text):
        ch = text[i]
        if quote == "'":
            if ch == "'":
                quote = ""
            else:
                word += ch
        elif ch == "\\":
            word = (word or "") + text[i + 1:i + 2]
            i += 1
        elif quote == '"':
            if ch == '"':
                quote = ""
            else:
                word += ch
        elif ch in "'\"":
            quote, word = ch, word or ""
        elif ch == " ":
            if word is not None:
                out.append(word)
            word = None
        else:
            word = (word or "") + ch
        i += 1
    return out + ([word] if word is not None else [])


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="ab \\'\"$\n", max_size=14), min_size=60, max_size=60))
def test_shell_words_equal_a_state_machine(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)] + [(10_000, None)]
    got = {r["i"]: r["w"] for r in spark.createDataFrame(rows, "i int, t string").select("i", shell_words("t").alias("w")).collect()}
    assert got.pop(10_000) == []
    assert got == {i: words_by_state(t) for i, t in enumerate(texts)}


def test_shell_words_of_a_long_command(spark):
    """A command line of 200,000 quoted words, and one word of 400,000 escapes, need no deep recursion."""
    many, one = '"a\\"b" ' * 200_000, '"' + "\\x" * 400_000
    df = spark.createDataFrame([(many,), (one,)], "t string").select(shell_words("t").alias("w"))
    got = df.select(F.size("w").alias("n"), F.length(F.col("w")[0]).alias("l")).collect()
    assert [(r["n"], r["l"]) for r in got] == [(200_000, 3), (1, 400_000)]


def test_paths(spark):
    cases = [("/a/./b//c/", "/a/b/c"), ("/../a", "/a"), ("a/../../b", "../b"), ("..", ".."), ("a/..", "."), ("/", "/"),
             ("/a/b/../../..", "/"), ("../../x", "../../x"), ("", ""), (None, None), ("a b/c", "a b/c")]
    df = spark.createDataFrame([(a, b) for a, b in cases], "p string, want string")
    assert all(r["got"] == r["want"] for r in df.select("want", normalize_path("p").alias("got")).collect())
    df = spark.createDataFrame([("/d/e", "../x.c", "/d/x.c"), ("/d/", "x.c", "/d/x.c"), (None, "x.c", "x.c"), ("", "./x.c", "x.c"),
                                ("/d", "/y//x.c", "/y/x.c"), ("/d", "", ""), ("/d", None, None)], "d string, p string, want string")
    assert all(r["got"] == r["want"] for r in df.select("want", resolve_path("d", "p").alias("got")).collect())


def test_database_with_quotes_and_two_folders(spark):
    d = tempfile.mkdtemp(prefix="pw-cdb-")
    json.dump([{"directory": d + "/p", "file": "x.cc", "command": "clang -c ./x.cc '-DA=1 2' ../q/x.cc -o x.o"},
               {"directory": d + "/q", "file": "../q/x.cc", "arguments": ["clang", "-c", "x.cc", "../p/../p/x.cc", "-Xclang", "-load"]}],
              open(os.path.join(d, "compile_commands.json"), "w"))
    db = files.compile_commands(spark, d).withColumn("cmd_id", F.col("directory"))
    exists = spark.createDataFrame([(d + "/p/x.cc",)], "path string")
    args = {r["cmd_id"][-1]: r["args"] for r in C.clean_compile_args(db, exists).collect()}
    assert args == {"p": ["-DA=1 2", "../q/x.cc"], "q": ["x.cc"]}
    assert sorted(r["path"] for r in db.collect()) == [d + "/p/x.cc", d + "/q/x.cc"]
    asked = spark.createDataFrame([(d + "/p/./x.cc",), (d + "/p/x.cc",), (d + "/p/y.cc",)], "file string")
    assert C.command_coverage(asked, db.select(F.col("path").alias("file"))).collect()[0][:] == (2, 1, 1)
    none = C.command_coverage(asked.limit(0), db.select(F.col("path").alias("file"))).collect()[0]
    assert none[:] == (0, 0, 0)
