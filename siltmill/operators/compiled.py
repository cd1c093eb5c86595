"""Source files compiled at two optimisation levels, and what came of it."""

from __future__ import annotations

import os
import shlex
import subprocess
import tempfile
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Commands by extension, for speed and for size; {src} and {out} are file names.
_CLANG = "-S {} -fno-discard-value-names -fstandalone-debug -emit-llvm {{src}} -o {{out}}"
_OBJC = "clang -S {} -std=c89 -fno-discard-value-names -fstandalone-debug -fmodules -emit-llvm {{src}} -o {{out}}"
_RUST = "rustc --emit=llvm-ir -C strip=symbols -C embed-bitcode=no -C debuginfo=0 -C codegen-units=1 -C opt-level={} -C inline-threshold=0 -C force-unwind-tables=off {{src}} -o {{out}}"
_D = "ldc2 {} --output-ll --noasm {{src}} -of {{out}}"
_FORTRAN = "flang-new-16 -S {} -fno-discard-value-names -fstandalone-debug -emit-llvm -ffree-form {{src}} -o {{out}}"
_GO = "llvm-goc -S {} -fno-inline -fno-integrated-as -emit-llvm -fno-debug-info-for-profiling -fno-go-debug-optimization {{src}} -o {{out}}"
_HASKELL = "sh -c 'ghc \"{{src}}\" -fllvm -keep-llvm-file {} && mv \"$(dirname {{src}})\"/source.ll \"{{out}}\"'"
_NIM = "nlvm compile --llvm-emit-call-site-info --llvm-Oz --opt:{} --compileOnly:on -o:{{out}} {{src}}"
COMMANDS = {
    "c": (f"clang-17 {_CLANG.format('-O3')}", f"clang-17 {_CLANG.format('-Oz')}"),
    "cpp": (f"clang++-17 {_CLANG.format('-O3')}", f"clang++-17 {_CLANG.format('-Oz')}"),
    "m": (_OBJC.format("-O3"), _OBJC.format("-Oz")),
    "rs": (_RUST.format("3"), _RUST.format("z")),
    "d": (_D.format("-O3"), _D.format("-Oz")),
    "f90": (_FORTRAN.format("-O3"), _FORTRAN.format("-O0")),
    "go": (_GO.format("-O3"), _GO.format("-Os")),
    "hs": (_HASKELL.format("-O3"), _HASKELL.format("-O0")),
    "nim": (_NIM.format("speed"), _NIM.format("size")),
}
# End of fixed values.
NOT_RUN = -1


def _status(command: str, src: str, out: str, seconds: int) -> int:
    try:
        words = [w.format(src=src, out=out) for w in shlex.split(command)]
        return subprocess.run(words, stdout=subprocess.DEVNULL, stderr=subprocess.DEVNULL, timeout=seconds, check=False).returncode
    except (OSError, subprocess.TimeoutExpired):
        return NOT_RUN


def compile_files(files: DataFrame, commands: Mapping[str, tuple[str, str]] = COMMANDS, seconds: int = 120) -> DataFrame:
    """source, extension, code -> source, perf_status, size_status, perf_out, size_out.

    Each file is compiled in a folder of its own on the executor, and what the compiler wrote comes back as text. The
    status is NOT_RUN without a command for the extension, without the compiler, or past the time.
    """
    commands = dict(commands)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for source, extension, code in zip(batch["source"], batch["extension"], batch["code"]):
                with tempfile.TemporaryDirectory() as folder:
                    src = os.path.join(folder, f"source.{extension}")
                    with open(src, "w") as f:
                        f.write(code or "")
                    row = [source]
                    texts = []
                    for k, command in enumerate(commands.get(extension, ("", ""))):
                        out = os.path.join(folder, f"out{k}.ll")
                        row.append(_status(command, src, out, seconds) if command else NOT_RUN)
                        texts.append(open(out, errors="replace").read() if os.path.exists(out) else None)
                    rows.append((*row, *texts))
            yield pd.DataFrame(rows, columns=["source", "perf_status", "size_status", "perf_out", "size_out"])

    return files.select("source", "extension", "code").mapInPandas(run, "source string, perf_status int, size_status int, perf_out string, size_out string")


def summary(results: DataFrame, *by: str) -> DataFrame:
    """n, and how many compiled at either and at both levels."""
    ok = lambda c: F.count_if(F.col(c) == 0)
    both = F.count_if((F.col("perf_status") == 0) & (F.col("size_status") == 0))
    return results.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), ok("perf_status").alias("n_perf"), ok("size_status").alias("n_size"), both.alias("n_both"), (both / F.count(F.lit(1))).alias("both_share"))
