"""Queries over the artifact catalog."""

from pyspark.sql import functions as F

from runweave.operators import artifacts as A
from runweave.plans import views as V
from runweave.plans.registry import query
from runweave.schemas import DEFAULT_IGNORE

MIME = {".html": "text/html", ".json": "application/json", ".txt": "text/plain"}
PATTERNS = ["/fr/", "*example.net*", "66"]


@query(
    "catalog_files",
    """select trim(regexp_replace(url, '[?#].*$', ''), './') as name, 'me' as username,
              greatest(1, strlen(html)) as size,
              page_id * 86400 as created_on, page_id * 86400 as last_modified, 1 as type,
              case when regexp_replace(url, '[?#].*$', '') like '%.html'
                   then 'text/html' else 'application/octet-stream' end as content_type
       from pages""",
)
def catalog_files(spark, sf_dir):
    """Catalog rows for the pages."""
    return A.catalog_files(_page_files(spark, sf_dir, "url"), "me", MIME)


def _page_files(spark, sf_dir, path):
    pages = V.table(spark, sf_dir, "pages")
    name = F.regexp_replace("url", "[?#].*$", "")
    if path == "name":
        name = F.regexp_replace(name, "^https?://", "")
    return pages.select(
        name.alias("path"),
        F.octet_length("html").cast("bigint").alias("length"),
        F.timestamp_seconds(F.col("page_id") * 86400).alias("modified"),
    )


@query(
    "put_tree",
    """select concat('en/7/', trim(concat('site/', trim(name, './')), './')) as name,
              greatest(1, size) as size, 'store' as relic_name,
              case when name like '%.html' then 'text/html'
                   else 'application/octet-stream' end as content_type
       from {files}""",
)
def put_tree(spark, sf_dir):
    """The pages put under a remote path of a prefixed store."""
    rows = A.put_tree(_page_files(spark, sf_dir, "name"), "site/", "me", MIME, "store", "en/7")
    return rows.select("name", "size", "relic_name", "content_type")


@query(
    "list_files",
    "select relic_id, name, size from {files} where starts_with(name, 'blog.')",
)
def list_files(spark, sf_dir):
    """All keys under a prefix, in every store."""
    return A.list_files(V.view(spark, sf_dir, "files"), "blog.", recurse=True).drop("type")


@query(
    "list_files_flat",
    """select relic_id, name, size from (
           select relic_id, regexp_replace(name, '^[^/]*/', '') as name, size from {files}) f
       where starts_with(name, 'en/') and not contains(rtrim(substr(name, 4), '/'), '/')""",
)
def list_files_flat(spark, sf_dir):
    """Keys under a folder with nothing below them."""
    files = V.view(spark, sf_dir, "files").withColumn(
        "name", F.regexp_replace("name", "^[^/]*/", "")
    )
    return A.list_files(files, "en/").drop("type")


@query(
    "list_dir",
    """select relic_id, child as name, case when bool_or(deep) then 2 else 1 end as type,
              count(*) as files, cast(sum(size) as bigint) as size
       from (select relic_id, split_part(name, '/', 1) as child, contains(name, '/') as deep, size
             from {files}) f
       group by relic_id, child""",
)
def list_dir(spark, sf_dir):
    """Top-level entries of each store."""
    return A.list_dir(V.view(spark, sf_dir, "files"))


@query(
    "list_dir_prefix",
    """select relic_id, concat('en/', child) as name,
              case when bool_or(deep) then 2 else 1 end as type, count(*) as files,
              cast(sum(size) as bigint) as size
       from (select relic_id, split_part(substr(name, 4), '/', 1) as child,
                    contains(substr(name, 4), '/') as deep, size
             from (select relic_id, regexp_replace(name, '^[^/]*/', '') as name, size
                   from {files}) g
             where starts_with(name, 'en/')) f
       group by relic_id, child""",
)
def list_dir_prefix(spark, sf_dir):
    """Entries of one folder of each store."""
    files = V.view(spark, sf_dir, "files").withColumn(
        "name", F.regexp_replace("name", "^[^/]*/", "")
    )
    return A.list_dir(files, "/en/")


@query(
    "has_file",
    """with refs as (
           select concat('r', cast(page_id % 4 as varchar)) as relic_id,
                  concat('/', regexp_replace(regexp_replace(url, '^https?://', ''),
                         '[?#].*$', ''), '//') as path from pages)
       select relic_id, path, exists (
           select 1 from {files} f
           where f.relic_id = r.relic_id and trim(f.name, '/') = trim(r.path, '/')) as exists
       from refs r""",
)
def has_file(spark, sf_dir):
    """Existence of one path per page, some asked of the wrong store."""
    refs = V.table(spark, sf_dir, "pages").select(
        F.concat(F.lit("r"), F.col("page_id") % 4).alias("relic_id"),
        F.concat(
            F.lit("/"),
            F.regexp_replace(F.regexp_replace("url", "^https?://", ""), "[?#].*$", ""),
            F.lit("//"),
        ).alias("path"),
    )
    return A.has_files(refs, V.view(spark, sf_dir, "files"))


@query(
    "ignore_files",
    """select relic_id, name, size from {files}
       where not (regexp_matches(name, '/fr/') or contains(name, 'example.net')
                  or ends_with(name, '66'))""",
)
def ignore_files(spark, sf_dir):
    """Files left after a folder, a glob and a suffix pattern."""
    return A.ignore_files(V.view(spark, sf_dir, "files"), PATTERNS).drop("type")


@query(
    "ignore_union",
    """with defaults(pattern) as (values ('__pycache__/'), ('venv/'), ('.git/'), ('.vscode/'))
       select pattern from (
           (select pattern from defaults union select p_name from part
            except select p_name from part where p_brand = 'Brand#3')
           union select concat(p_type, '/') from part) x""",
)
def ignore_union(spark, sf_dir):
    """Default, user and file patterns less the forced includes."""
    part = V.table(spark, sf_dir, "part")
    defaults = spark.createDataFrame([(p,) for p in DEFAULT_IGNORE], "pattern string")
    included = part.where(F.col("p_brand") == "Brand#3").select(F.col("p_name").alias("pattern"))
    return A.ignore_union(
        defaults,
        part.select(F.col("p_name").alias("pattern")),
        included,
        part.select(F.concat("p_type", F.lit("/")).alias("pattern")),
    )


@query(
    "delete_files",
    """select relic_id, object_name as name, operation from {activity}
       where not (operation = 3)""",
)
def delete_files(spark, sf_dir):
    """Objects left after those with a delete operation are gone."""
    objects = V.view(spark, sf_dir, "activity").select(
        "relic_id", F.col("object_name").alias("name"), "operation"
    )
    return A.delete_files(objects, objects.where(F.col("operation") == 3))


@query(
    "activity_log",
    """select timestamp_ns, relic_id, operation, cast(object_size as double) as object_size,
              username, object_name
       from {activity} where relic_id = 'r2' and timestamp_ns >= 1704499200000000000
         and timestamp_ns <= 1706054400000000000""",
)
def activity_log(spark, sf_dir):
    """Operations of one store in a closed time range."""
    found = A.activity_log(
        V.view(spark, sf_dir, "activity"),
        relic_id="r2",
        from_timestamp_ns=1704499200000000000,
        to_timestamp_ns=1706054400000000000,
    )
    return found.withColumn("object_size", F.col("object_size").cast("double"))


@query(
    "list_relics",
    """select id, name, created_on, total_relics from (
           select 'r' || c_custkey as id, c_name as name, c_custkey * 7 as created_on,
                  count(*) over () as total_relics,
                  row_number() over (order by c_name, 'r' || c_custkey) as n
           from customer where c_nationkey < 12) r where n > 40 and n <= 80""",
)
def list_relics(spark, sf_dir):
    """Third page of the stores of some workspaces, with their total number."""
    relics = V.table(spark, sf_dir, "customer").where("c_nationkey < 12").select(
        F.concat(F.lit("r"), "c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        (F.col("c_custkey") * 7).alias("created_on"),
    )
    return A.list_relics(relics, page=3, page_size=20).unionAll(
        A.list_relics(relics, page=4, page_size=20)
    )


@query(
    "list_relics_name",
    """select 'r' || c_custkey as id, c_name as name, 1 as total_relics from customer
       where c_name = (select min(c_name) from customer)""",
)
def list_relics_name(spark, sf_dir):
    """One store by its name."""
    customers = V.table(spark, sf_dir, "customer")
    first = customers.agg(F.min("c_name")).first()[0]
    relics = customers.select(F.concat(F.lit("r"), "c_custkey").alias("id"), F.col("c_name").alias("name"))
    return A.list_relics(relics, relic_name=first)


@query(
    "page_of_files",
    """select relic_id, name, size, total_files from (
           select relic_id, name, size, count(*) over () as total_files,
                  row_number() over (order by relic_id, name, size) as n
           from {files} where relic_id = 'r1') f
       where n > 5 and n <= 10""",
)
def page_of_files(spark, sf_dir):
    """Second page of the keys of one store, with their total number."""
    files = V.view(spark, sf_dir, "files")
    found = A.page_of_files(files, recurse=True, relic_id="r1", page=2, page_size=5)
    return found.drop("type")
