
import json
import sys

MARK = "## Measured by us"


def render(result: dict) -> str:
    lines = [MARK, "",
             f"`bench.py` at sf{result['sf']}: `local[{result['cpus']}]`, Spark {result['spark']}, "
             f"`spark.sql.shuffle.partitions={result['shuffle_partitions']}` (AQE on), median of 3 runs "
             "per query after a JVM warm-up, each query fully computed into the `noop` sink. "
             "There is no reference figure to compare with (none is published).", "",
             "| query | seconds |", "| --- | --- |"]
    lines += [f"| `{k}` | {v:.3f} |" for k, v in result["queries"].items()]
    lines += [f"| **total** | **{result['value']:.3f}** |", ""]
    return "\n".join(lines)


if __name__ == "__main__":
    result = json.loads(open(sys.argv[1]).read().strip().splitlines()[-1])
    path = sys.argv[2]
    text = open(path).read()
    if MARK in text:
        text = text[:text.index(MARK)].rstrip() + "\n"
    open(path, "w").write(text.rstrip() + "\n\n" + render(result))
