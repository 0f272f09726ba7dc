"""Word count job: text files in, ``word<TAB>n`` lines in word order out.

    python -m skyledger.plans.wordcount --input FILES_OR_FOLDERS --output DIR
"""

from __future__ import annotations

import argparse

from ..operators import word_count, write_word_counts
from ..session import build_session
from ..sources import read_text_files


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description="Word count over text files")
    ap.add_argument("--input", required=True, nargs="+", help="text files or folders")
    ap.add_argument("--output", required=True)
    ap.add_argument("--master")
    args = ap.parse_args(argv)
    spark = build_session(args.master, app_name="skyledger-wordcount")
    write_word_counts(word_count(read_text_files(spark, args.input)), args.output)


if __name__ == "__main__":
    main()
