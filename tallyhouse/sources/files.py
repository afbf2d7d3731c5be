"""Path helpers on the Hadoop file system of a path, so any store Spark can reach works."""


def hadoop_path(spark, path):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(str(path))
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark, path):
    fs, target = hadoop_path(spark, path)
    return fs.exists(target)


def list_names(spark, path, suffix=""):
    """Names of the entries directly below a folder, sorted."""
    fs, target = hadoop_path(spark, path)
    if not fs.exists(target):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if s.getPath().getName().endswith(suffix))


def delete(spark, path):
    """Remove a file or a folder with all below it."""
    fs, target = hadoop_path(spark, path)
    return fs.delete(target, True)
