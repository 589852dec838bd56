"""Commands: python -m lexloom list | run QUERY DATA OUT | index DATA | search DATA TEXT."""

from __future__ import annotations

import argparse

from lexloom.plans import registry
from lexloom.session import build_session, sweep


def main(args: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lexloom", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("list", help="the names of all queries")
    run = sub.add_parser("run", help="run a query over a folder of tables and write its rows as Parquet")
    run.add_argument("query")
    run.add_argument("data")
    run.add_argument("out")
    index = sub.add_parser("index", help="build the stored text index of the chunks, unless it is there")
    index.add_argument("data")
    search = sub.add_parser("search", help="the ten best chunks for a text")
    search.add_argument("data")
    search.add_argument("text")
    a = p.parse_args(args)
    if a.command == "list":
        print("\n".join(registry.queries()))
        return 0
    from lexloom.operators.retrieval import ranked
    from lexloom.plans.relations import index_of

    spark = build_session("lexloom")
    if a.command == "run":
        from lexloom.sources.files import check_output

        registry.queries()[a.query](spark, a.data).write.mode("overwrite").parquet(check_output(a.out, [a.data]))
        sweep(spark)
    elif a.command == "index":
        print(index_of(spark, a.data).whole.first().asDict())
    else:
        asked = spark.createDataFrame([(0, a.text)], "query_id int, text string")
        for r in ranked(index_of(spark, a.data).scores(asked), "id", 10).orderBy("rank").collect():
            print(r["rank"], round(r["score"], 4), r["id"])
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
