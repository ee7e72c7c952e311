"""The batch job of one experiment: every step is a table that is written once and read where it is there already."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cellgrid.operators import cells, codebook, matrix, molecules, spatial, tiles
from cellgrid.sources.config import Config


@dataclass
class Job:
    """Inputs are tables; outputs lie below the configured output folder."""

    spark: SparkSession
    config: Config
    molecules: DataFrame
    book: DataFrame
    positions: DataFrame
    mask: DataFrame
    drifts: DataFrame | None = None
    #: Tile arrays of the masks; where they are given, molecules are looked up in them.
    tiles: DataFrame | None = None
    _made: set[str] = field(default_factory=set)

    def _once(self, name: str, make: Callable[[], DataFrame], then: Callable[[], None] | None = None) -> DataFrame:
        """The table `name`, made if it is missing or a rerun is asked for; `then` runs after it is made."""
        path = f"{self.config.path('output_root', segmented=True)}/{name}"
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if name not in self._made and (self.config.rerun or not at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)):
            make().write.mode("overwrite").parquet(path)
            if then is not None:
                then()
        self._made.add(name)
        return self.spark.read.parquet(path)

    @property
    def kept(self) -> DataFrame:
        omitted = list(self.config.omit_fovs)
        return self.molecules.where(~self.molecules.fov.isin(omitted)) if omitted else self.molecules

    @property
    def overlaps(self) -> DataFrame:
        return spatial.fov_overlaps(self.positions, pixels=self.config.mask_size)

    def links(self) -> DataFrame:
        return self._once("linked_cells", lambda: cells.linked_cells(self.mask, self.overlaps, self.config.mask_size))

    def cell_metadata(self) -> DataFrame:
        """Cells with linked ones merged; those outside the configured volumes drop out."""

        def make() -> DataFrame:
            table = cells.cell_metadata(self.mask, self.positions, self.overlaps, self.links(), self.config.mask_size, float(self.config.scale))
            return table.where((table.volume >= self.config.minimum_cell_volume) & (table.volume <= self.config.maximum_cell_volume))

        return self._once("cell_metadata", make)

    def barcodes(self) -> DataFrame:
        """Decoded molecules, trimmed of overlaps, with cell and stage coordinates. How many came in and how many stayed is counted by the pass that writes them."""
        came, stayed = Observation("came"), Observation("stayed")
        one = F.count(F.lit(1)).alias("n")

        def make() -> DataFrame:
            decoded = codebook.decode(self.kept.observe(came, one), codebook.expand(self.book))
            trimmed = molecules.trim_overlaps(decoded, spatial.fov_overlaps(self.positions, trim=True))
            flip = self.config.flip_barcodes
            how = (self.drifts, self.config.scale, self.config.transpose_barcodes, flip, flip, self.config.mask_size)
            assigned = molecules.assign_to_cells(trimmed, self.mask, *how) if self.tiles is None else tiles.assign_by_tiles(trimmed, self.tiles, *how)
            return molecules.link_cells(molecules.with_global_xy(assigned, self.positions), self.links()).observe(stayed, one)

        def note() -> None:
            counted = [("unfiltered", came.get["n"]), ("filtered", stayed.get["n"])]
            self.spark.createDataFrame(counted, "name string, n long").coalesce(1).write.mode("overwrite").parquet(f"{self.config.path('output_root', segmented=True)}/barcode_counts")

        return self._once("barcodes", make, note)

    def barcode_counts(self) -> dict[str, int]:
        """unfiltered, filtered: molecules that came in, and those of the barcode table."""
        self.barcodes()
        path = f"{self.config.path('output_root', segmented=True)}/barcode_counts"
        return {r["name"]: r["n"] for r in self.spark.read.schema("name string, n long").parquet(path).collect()}

    def stats(self, unfiltered: int | None = None) -> DataFrame:
        """metric, value; the unfiltered count is the one taken while barcodes were written, unless another is given."""
        fovs = self.positions.count()
        n = self.barcode_counts()["unfiltered"] if unfiltered is None else unfiltered
        return self._once("stats", lambda: molecules.barcode_stats(self.barcodes(), n, fovs, list(self.config.colors)))

    def counts(self) -> DataFrame:
        return self._once("cell_by_gene", lambda: molecules.cell_by_gene(self.barcodes()))

    def matrix(self, keep_empty_cells: bool = True) -> dict[str, DataFrame]:
        """x (with normalised values), obs (with the place on the stage), var and bits (counts by bit of the codebook) of the annotated matrix.

        obs has every cell of the metadata, those without molecules with zeros; without `keep_empty_cells` these are left out.
        """
        who = matrix.with_spatial(self.cell_metadata().withColumnRenamed("cell_id", "cell"))
        counts = self.counts().withColumnRenamed("cell_id", "cell")
        if not keep_empty_cells:
            who = who.join(counts.select("cell").distinct(), "cell", "left_semi")
        placed = lambda: matrix.cell_metrics(counts, who, "volume").join(who.select("cell", "fov", "spatial_x", "spatial_y"), "cell")
        make = {"x": lambda: matrix.normalise(counts), "obs": placed, "var": lambda: matrix.gene_metrics(counts, who), "bits": lambda: matrix.bit_counts(counts, self.book)}
        return {name: self._once(f"matrix/{name}", f) for name, f in make.items()}
