"""A batch of laws from their sources to a release: ``python -m tabularium.plans.batch REGISTRY SOURCES OUT [LAW_ID ...]``.

All laws go through a stage together, and each stage leaves a Parquet table under OUT. A later run takes up the tables that are whole
and goes on from the first that isn't; a law that fails a gate is in no later table."""

from __future__ import annotations

import argparse
import importlib
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..clients.keys import exit_code
from ..operators import assemble, chunk, cleanup, confidence, corpus_checks, enrich, extract, refs, release, review, split, split_checks, state
from ..sources import readers, sinks
from ..sources.stages import stored

#: Stages in order. ``confidence`` and ``split_check`` are gates; validation only warns.
STAGES = ("extract", "clean", "confidence", "split", "split_check", "enrich", "chunk", "review", "validate", "assemble", "release")


class Batch:
    """The stages over one registry. ``native`` holds the texts of documents that aren't text files, ``recognise`` reads those that it lacks, ``client`` answers prompts;
    without one no metadata is made up: articles that no earlier run has completed stay ``not_reached``. ``settings``: batch size and model."""

    def __init__(self, registry: DataFrame, texts: DataFrame, out: str, native: DataFrame | None = None, recognise: Callable[[DataFrame], DataFrame] | None = None,
                 client: Callable | None = None, cutter: Callable | None = None, concepts=None, settings: readers.Settings = readers.Settings()) -> None:
        self.spark, self.registry, self.texts, self.out = registry.sparkSession, registry, texts, out.rstrip("/")
        self.native, self.recognise, self.client, self.cutter, self.concepts, self.settings = native, recognise, client, cutter, concepts, settings

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.out}/{name}")

    def whole(self, name: str) -> bool:
        fs, place = sinks._folder(self.spark, f"{self.out}/{name}/_SUCCESS")
        return fs.exists(place)

    def write(self, df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{self.out}/{name}")

    def run(self, stages: set[str] | None = None, force: bool = False, reenrich: bool = False) -> DataFrame:
        """The results of the batch. Stages that are asked for by name run anew, as does everything with ``force``; others only where their table is missing.
        ``reenrich`` asks again for metadata that is there."""
        if unknown := set(stages or ()) - set(STAGES):
            raise ValueError(f"no such stage: {sorted(unknown)}; there are {list(STAGES)}")
        anew = not self.covers()
        for at, name in enumerate(STAGES):
            if stages is None:
                anew = anew or force or (reenrich and name == "enrich") or not self.whole(name)  # what follows a stage that has run is out of date
                asked = anew
            else:
                asked = name in stages
                if asked and (lost := [p for p in STAGES[:at] if not self.whole(p)]):
                    raise FileNotFoundError(f"stage {name} needs the tables of {lost}")
            if asked:
                getattr(self, f"_{name}")(reenrich)
        return self.results()

    def covers(self) -> bool:
        """Whether the tables that are there were made of all laws of this registry."""
        return self.whole("extract") and self.registry.join(self.table("extract"), "law_id", "left_anti").isEmpty()

    def _extract(self, _: bool) -> None:
        self.write(extract.extracted(self.registry, self.texts, None, self.native, self.recognise), "extract")

    def _clean(self, _: bool) -> None:
        self.write(cleanup.clean(self.table("extract").filter("success").select("law_id", F.col("text").alias("raw_text"))), "clean")

    def _scanned(self) -> DataFrame:
        rows = self.table("clean").select("law_id", "text").join(self.registry, "law_id")
        return split.scanned(rows, exclusions="manual_marker_exclusions")

    def _confidence(self, _: bool) -> None:
        self.write(confidence.scored(self._scanned()), "confidence")

    def _split(self, _: bool) -> None:
        passed = self.table("confidence").filter("passed").select("law_id")
        self.write(self._scanned().join(passed, "law_id", "left_semi").select("law_id", "orphan", "hits", "repealed_articles"), "hits")
        rows = split.articles(self.table("hits"), repealed="repealed_articles")
        self.write(rows.withColumn("cross_refs", refs.cross_refs(F.col("text"))), "split")

    def _split_check(self, _: bool) -> None:
        report = split.report(self.table("hits"), self.table("split"), self.registry)
        self.write(split_checks.all_issues(self.table("split"), report, self.registry), "split_issues")
        self.write(split_checks.gate(self.table("split_issues"), self.table("hits")), "split_check")

    def _good(self) -> DataFrame:
        return self.table("split").join(self.table("split_check").filter("passed").select("law_id"), "law_id", "left_semi")

    def _enrich(self, reenrich: bool) -> None:
        """Metadata is an upserted table by article: what earlier runs completed isn't asked for again."""
        place, rows = f"{self.out}/metadata", self._good()
        old = sinks.current(self.spark, place, "article_id")
        if self.client is not None:
            work = rows if old is None else enrich.work_list(rows, old, reenrich)
            log = None if reenrich else f"{self.out}/replies"  # whoever wants everything anew wants no old answers
            fresh = enrich.cascade(work, self.registry, self.client, self.settings.batch_size, self.settings.primary_model, self.concepts, log)
            sinks.upsert(fresh, place, "article_id")
            old = sinks.current(self.spark, place, "article_id")
        known = enrich.none(self.spark) if old is None else old
        out = rows.join(known, "article_id", "left")
        self.write(out.withColumn("enrichment_error", F.when(F.col("enrichment_status").isNull(), "not_reached").otherwise(F.col("enrichment_error"))), "enrich")

    def _chunk(self, _: bool) -> None:
        rows = self.table("enrich").drop("cross_refs", "concepts", "applicable_to")
        if self.cutter is None:
            self.write(chunk.chunked(rows), "chunk")
        else:
            replies = enrich.called(enrich.semantic_prompts(rows), self.cutter).select("article_id", "reply")
            self.write(chunk.chunked(rows.join(replies, "article_id", "left"), reply="reply"), "chunk")

    def _review(self, _: bool) -> None:
        rows, chunks = self.table("enrich"), self.table("chunk")
        sinks.review_csv(review.article_rows(rows, chunks), f"{self.out}/review_articles")
        sinks.review_csv(review.chunk_rows(chunks), f"{self.out}/review_chunks")
        self.write(review.stats(rows, chunks), "review")

    def _validate(self, _: bool) -> None:
        self.write(corpus_checks.issues(self.table("enrich"), self.registry), "corpus_issues")
        self.write(corpus_checks.gate(self.table("corpus_issues"), self.table("enrich").select("law_id").distinct()), "validate")

    def _assemble(self, _: bool) -> None:
        rows, chunks = self.table("enrich").withColumn("ordinal", F.col("sequence_index").cast("long")), self.table("chunk")
        last = assemble.ordered(assemble.flagged(assemble.keep_last(rows), self.registry))
        self.write(assemble.with_provenance(last, self.registry, self.table("confidence")), "assemble")
        self.write(assemble.chunk_flags(chunks, self.table("assemble")), "assembled_chunks")
        self.write(assemble.full_report(rows, self.table("assemble"), chunks, self.table("assembled_chunks"), self.registry), "assembly_report")

    def _release(self, _: bool) -> None:
        rows, chunks = self.table("assemble"), self.table("assembled_chunks")
        sinks.json_lines(rows, f"{self.out}/release_articles")
        sinks.json_lines(chunks, f"{self.out}/release_chunks")
        stats = release.statistics(rows, chunks)
        self.write(release.metadata(stats, release.histogram(rows, "article_category", "أخرى"), release.histogram(rows, "enrichment_model", "unknown"), self.registry), "release")

    def results(self) -> DataFrame:
        """(law_id, extraction_source, confidence, articles_found, chunks, forms, warnings, status, reason), a row for each law; ``status`` is ok, the gate
        that failed, or the first stage that is still to run."""
        out = self.registry.select("law_id")
        parts = {
            "extract": {"extraction_source": F.max("extraction_source"), "_extracted": F.bool_or("success"), "_error": F.max("error")}, "clean": {"forms": F.max("presentation_forms_normalized")},
            "confidence": {"confidence": F.max("confidence_score"), "_confident": F.bool_or("passed")}, "split": {"articles_found": F.count("*")}, "split_check": {"_split": F.bool_or("passed"), "_errors": F.max("errors")},
            "chunk": {"chunks": F.count("*")}, "validate": {"warnings": F.max(F.col("errors") + F.col("warnings"))},
        }
        gates = {"extract": "_extracted", "confidence": "_confident", "split_check": "_split"}
        status, done = F.lit(None).cast("string"), True
        for name in STAGES:
            if name in parts:
                if self.whole(name):
                    out = out.join(self.table(name).groupBy("law_id").agg(*[c.alias(k) for k, c in parts[name].items()]), "law_id", "left")
                else:
                    out = out.withColumns({k: F.lit(None) for k in parts[name]})
            if done and not self.whole(name):
                status, done = F.coalesce(status, F.lit(f"pending:{name}")), False
            elif done and name in gates:
                status = F.coalesce(status, F.when(~F.coalesce(F.col(gates[name]), F.lit(False)), f"fail:{name.removesuffix('_check')}"))
        out = out.withColumn("status", F.coalesce(status, F.lit("ok")))
        why = F.when(F.col("status") == "fail:extract", F.coalesce(F.col("_error").cast("string"), F.lit("no source"))).when(F.col("status") == "fail:confidence", F.concat(F.lit("score "), F.col("confidence").cast("string")))
        why = why.when(F.col("status") == "fail:split", F.concat(F.coalesce(F.col("_errors").cast("string"), F.lit("0")), F.lit(" errors")))
        return out.select("law_id", "extraction_source", "confidence", "articles_found", "chunks", "forms", "warnings", "status", why.alias("reason"))


#: The stages that work law by law, and what each reads besides the table of the stage before it: columns of the registry, ``_plain`` and ``_native`` are fingerprints of the law's texts.
_COUNTS = ("expected_article_count", "expected_chapter_headings")
INPUTS = {
    "extract": ("txt_filename", "pdf_filename", "_plain", "_native"), "clean": (), "confidence": (*_COUNTS, "manual_marker_exclusions"), "split": ("repealed_articles",), "split_check": _COUNTS,
    "enrich": ("law_name_ar", "law_number", "year", "_client"), "chunk": ("_cutter",),
}
#: Tables that a stage writes besides its own.
_OF_STAGE = {name: name for name in INPUTS} | {"hits": "split", "split_issues": "split_check"}


class Incremental(Batch):
    """A batch that is run again and again as laws come, change and go: a stage reads and writes only laws whose inputs are not those of its last run.

    Tables of the stages that work law by law are folders of generations, one a run; ``state`` tells which generation of a law and stage counts, and is appended to once a
    stage's rows are whole, so a run that breaks off is taken up after its last whole stage. Review, validation, assembly and release order the whole corpus: they run
    anew, over the rows that count, if any law has changed. Laws that have left the registry are read no more. Articles of a law that is enriched anew are asked for anew."""

    generation, running, only = 0, "", None

    def state(self) -> DataFrame:
        place = f"{self.out}/state"
        return self.spark.read.schema(state.STATE).parquet(place) if self._there(place) else self.spark.createDataFrame([], state.STATE)

    def _there(self, path: str) -> bool:
        fs, place = sinks._folder(self.spark, path)
        return fs.exists(place)

    def whole(self, name: str) -> bool:
        return self._there(f"{self.out}/{name}") if name in _OF_STAGE else super().whole(name)

    def table(self, name: str) -> DataFrame:
        if name not in _OF_STAGE:
            return super().table(name)
        if _OF_STAGE[name] == self.running:  # what this stage has just written
            return self.spark.read.parquet(f"{self.out}/{name}/generation={self.generation}")
        laws = self.registry.select("law_id") if self.only is None else self.only
        counts = state.newest(self.state().filter(F.col("stage") == _OF_STAGE[name])).join(laws, "law_id", "left_semi").select("law_id", "generation")
        folders = [r["generation"] for r in counts.select("generation").distinct().collect()]  # a row a run at most
        rows = self.spark.read.parquet(f"{self.out}/{name}").withColumn("generation", F.col("generation").cast("long"))
        return rows.filter(F.col("generation").isin(folders)).join(counts, ["law_id", "generation"], "left_semi").drop("generation")

    def write(self, df: DataFrame, name: str) -> None:
        super().write(df, f"{name}/generation={self.generation}" if name in _OF_STAGE else name)

    def prints(self) -> DataFrame:
        """Fingerprints of all stages of all laws."""
        plain = self.texts.select(F.col("name").alias("txt_filename"), F.sha2("raw_text", 256).alias("_plain"))
        laws = self.registry.join(plain, "txt_filename", "left")
        if self.native is not None:
            native = self.native.select(F.col("name").alias("pdf_filename"), F.sha2(F.concat_ws("\n", "raw_text", "page_count"), 256).alias("_native"))
            laws = laws.join(native, "pdf_filename", "left")
        inputs = dict(INPUTS) | ({"extract": (*INPUTS["extract"], *_COUNTS)} if self.native is not None else {})  # its score decides there
        laws = laws.withColumns({"_client": F.lit(self.client is not None), "_cutter": F.lit(self.cutter is not None)})
        return state.fingerprints(laws, inputs)

    def run(self, stages: set[str] | None = None, force: bool = False, reenrich: bool = False) -> DataFrame:
        """The results. ``stages``: run these for all laws, whatever state says; ``force``: all stages."""
        if unknown := set(stages or ()) - set(STAGES):
            raise ValueError(f"no such stage: {sorted(unknown)}; there are {list(STAGES)}")
        laws, last = self.registry, self.state()
        self.generation = (last.agg(F.max("generation")).first()[0] or 0) + 1
        now = stored(self.prints(), "prints")
        chain = list(INPUTS)
        first = 0 if force else min((chain.index(x) for x in stages or () if x in chain), default=len(chain))
        anyway = [*chain[first:], *(["enrich", "chunk"] if reenrich else [])]  # what follows a stage that runs is out of date
        todo = stored(state.stale(now, last).unionByName(now.filter(F.col("stage").isin(anyway))).distinct(), "stale")
        for name in chain:
            rows = todo.filter(F.col("stage") == name)
            if rows.isEmpty():
                continue
            self.only, self.running = rows.select("law_id"), name
            self.registry = laws.join(self.only, "law_id", "left_semi")
            try:
                getattr(self, f"_{name}")(name == "enrich")
            finally:
                self.registry, self.only, self.running = laws, None, ""
            rows.select("law_id", "stage", "print", F.lit(self.generation).cast("long").alias("generation")).write.mode("append").parquet(f"{self.out}/state")
        corpus = [n for n in STAGES if n not in INPUTS]
        # the corpus as a whole is one more row of state
        print_ = now.filter(F.col("stage") == chain[-1]).agg(F.concat_ws(",", F.count("*"), F.expr("bit_xor(xxhash64(law_id, print))")).alias("print"))
        whole = print_.select(F.lit("").alias("law_id"), F.lit("corpus").alias("stage"), "print")
        if anyway or stages or not todo.isEmpty() or not all(self.whole(n) for n in corpus) or not state.stale(whole, last).isEmpty():
            for name in corpus:
                getattr(self, f"_{name}")(False)
            whole.withColumn("generation", F.lit(self.generation).cast("long")).write.mode("append").parquet(f"{self.out}/state")
        return self.results()


def shown(results: DataFrame) -> dict[str, int]:
    """Print totals and the first failures; how many laws have each status."""
    totals = results.groupBy("status").agg(F.count("*").alias("laws"), F.sum("articles_found").alias("articles"), F.sum("chunks").alias("chunks"), F.round(F.avg("confidence"), 4).alias("confidence"))
    rows = totals.orderBy("status").collect()  # a row for each status
    print(f"{'status':<18}{'laws':>10}{'articles':>12}{'chunks':>12}{'confidence':>12}")
    for r in rows:
        print(f"{r['status']:<18}{r['laws']:>10,}{r['articles'] or 0:>12,}{r['chunks'] or 0:>12,}{r['confidence'] if r['confidence'] is not None else '-':>12}")
    for r in results.filter("status like 'fail:%'").orderBy("law_id").limit(20).collect():
        print(f"  {r['law_id']} failed at {r['status'].removeprefix('fail:')}: {r['reason']}")
    return {r["status"]: r["laws"] for r in rows}


def code(counts: dict[str, int]) -> int:
    """0 if no law failed; one law's failure has its own code, several mean 1, and so does a batch of no laws."""
    failed = {s: n for s, n in counts.items() if s.startswith("fail:")}
    if not counts:
        return 1
    return exit_code(next(iter(failed))) if sum(counts.values()) == 1 and failed else int(bool(failed))


def named(place: str | None) -> Callable | None:
    """The function that ``module:function`` names."""
    if place is None:
        return None
    module, _, name = place.partition(":")
    return getattr(importlib.import_module(module), name)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    parser = argparse.ArgumentParser(description="Laws from their sources to a release. Without ids: all laws whose source is there.")
    parser.add_argument("registry")
    parser.add_argument("sources")
    parser.add_argument("out")
    parser.add_argument("law_ids", nargs="*", metavar="LAW_ID")
    parser.add_argument("--stages", nargs="+", choices=STAGES, help="run these anew, from the tables that are there")
    parser.add_argument("--incremental", action="store_true", help="keep generations: a later run works on the laws that are new or changed only")
    parser.add_argument("--force", action="store_true", help="run all stages anew")
    parser.add_argument("--force-reenrich", action="store_true", help="ask again for metadata that is there")
    parser.add_argument("--client", metavar="MODULE:FUNCTION", help="answers prompts (a function of mapInPandas); without one no article is enriched")
    parser.add_argument("--native", metavar="TABLE", help="a Parquet table (name, raw_text, page_count) of the texts of documents")
    parser.add_argument("--recognise", metavar="MODULE:FUNCTION", help="from (name, page_count) of documents without a text to (name, raw_text)")
    given = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName("batch").getOrCreate()
    laws = readers.with_sources(readers.registry(spark, given.registry), readers.files(spark, given.sources))
    if given.law_ids:
        known = {r["law_id"] for r in laws.select("law_id").filter(F.col("law_id").isin(given.law_ids)).collect()}  # no more than were named
        for missing in sorted(set(given.law_ids) - known):
            print(f"no law {missing}")
        laws = laws.filter(F.col("law_id").isin(sorted(known)))
    else:
        laws = laws.filter("source_exists")
    if laws.isEmpty():
        print("no law to run")
        return 1
    kind = Incremental if given.incremental else Batch
    batch = kind(laws.drop("source", "source_exists"), readers.whole_texts(spark, given.sources), given.out, spark.read.parquet(given.native) if given.native else None, named(given.recognise),
                  named(given.client), settings=readers.Settings.from_env())
    return code(shown(batch.run(set(given.stages) if given.stages else None, given.force, given.force_reenrich)))


if __name__ == "__main__":
    sys.exit(main())
