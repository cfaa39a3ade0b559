"""Calls resolved to the methods they mean, by three equi-joins: the caller's own class and its ancestors, the type of the
receiver and its ancestors, and methods that only one class has. A class, its ancestors or the sole owner is part of
every key, so a name that a million classes share meets only its own class's methods.

A receiver's type is that of a parameter, else of a field or property of the class or its nearest ancestor, else the type
it names itself. Of a class's candidates the nearest in the hierarchy is taken; of overloads there the one whose parameters
fit literal arguments, then the one that needs no default values, then one without `params`, then the first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import graph
from . import binding

CALLER_KINDS = ("method", "ctor", "operator")
ANY_NUMBER = -1
PARAMETER = r"^\s*(?:\[[^\]]*\]\s*)*(?:(?:this|ref|out|in|params|scoped|readonly)\s+)*(.*?)\s*\b(\w+)\s*(?:=.*)?$"
NAMING = r"^((public|private|protected|internal|static|virtual|override|abstract|sealed|new|readonly|required|const|volatile)\s+)+"


def parameters(text: Column) -> Column:
    """Parameters as written, lists in brackets shortened to what separates them from others."""
    return F.when(F.trim(text) == "", F.array().cast("array<string>")).otherwise(F.split(binding.without_lists(text), ","))


def parameter_types(text: Column) -> Column:
    """Types as written, in order; commas inside type arguments are kept apart from those between parameters."""
    kept = F.regexp_replace(F.regexp_replace(text, r'"(?:[^"\\]|\\.)*"', "s"), r"\[[^\[\]]*[A-Za-z][^\[\]]*\]", "")
    for _ in range(4):  # a comma within angles or parentheses becomes another character
        kept = F.regexp_replace(kept, r"([<(][^<>(),]*),(?=[^<>()]*[>)])", "$1\u0001")
    return F.when(F.trim(text) == "", F.array().cast("array<string>")).otherwise(F.transform(F.split(kept, ","), lambda p: F.replace(F.regexp_extract(p, PARAMETER, 1), F.lit("\u0001"), F.lit(","))))


def parameter_names(text: Column) -> Column:
    return F.transform(parameters(text), lambda p: F.regexp_extract(p, PARAMETER, 2))


def targets_of(syntax: DataFrame, types: binding.Types) -> DataFrame:
    """Methods that can be called, a row for each number of arguments they take: path, ord, owner (its type's key), name, n,
    total, extension, types. `n` is ANY_NUMBER where `params` takes any number from `least` on."""
    m = syntax.select("path", F.inline("members")).filter("kind = 'method'").join(types.parts.select("path", "class_ord", F.col("key").alias("owner")), ["path", "class_ord"])
    text = F.col("param_text")
    extension = text.rlike(r"^\s*(\[[^\]]*\]\s*)*this\s")
    variadic = F.exists(parameters(text), lambda p: p.rlike(r"^\s*params\s"))
    least = F.col("params") - F.size(F.filter(parameters(text), lambda p: p.contains("="))) - variadic.cast("int")
    rows = m.select("path", "ord", "owner", "name", F.col("params").alias("total"), least.alias("least"), extension.alias("extension"), variadic.alias("variadic"), parameter_types(text).alias("types"))
    numbers = F.concat(F.sequence(F.greatest(F.col("least"), F.lit(0)), F.greatest(F.col("total"), F.col("least"), F.lit(0))), F.when(F.col("variadic"), F.array(F.lit(ANY_NUMBER))).otherwise(F.array().cast("array<int>")))
    return rows.withColumn("n", F.explode(F.array_distinct(numbers)))


def calls_of(syntax: DataFrame, types: binding.Types) -> DataFrame:
    """Calls of methods, constructors, operators and accessors: path, member_ord, call, own (the class's key), ns, usings,
    name, args, receiver (null for the class itself) and whether it is `base`."""
    inside = syntax.select("path", F.inline("members")).filter(F.col("kind").isin(*CALLER_KINDS) | F.col("accessors")).select("path", F.col("ord").alias("member_ord"), "class_ord", "param_text")
    made = syntax.select("path", F.inline("invocations")).select("path", "member_ord", F.col("ord").alias("call"), "name", "args", "chain", F.expr("size(chain)").alias("parts"), F.contains(F.col("call_text"), F.lit(")")).alias("nested"))
    rows = made.join(inside, ["path", "member_ord"]).join(types.parts.select("path", "class_ord", F.col("key").alias("own"), "ns", "usings"), ["path", "class_ord"])
    before, lead = F.get("chain", F.col("parts") - 2), F.get("chain", F.lit(0))
    itself = (F.col("parts") == 1) & ~F.col("nested") | (F.col("parts") == 2) & before.isin("this", "base")
    plain = (F.col("parts") == 2) | (F.col("parts") == 3) & lead.isin("this", "base")
    receiver = F.when(itself, None).when(plain & ~F.col("nested"), before).otherwise("")
    return rows.select("path", "member_ord", "call", "own", "ns", "usings", "name", "args", "param_text", receiver.alias("receiver"), ((F.col("parts") == 2) & (before == "base")).alias("above"), F.size("args").alias("n"))


def receiver_types(syntax: DataFrame, calls: DataFrame, types: binding.Types) -> DataFrame:
    """(path, member_ord, receiver, start): the key of the type that a name stands for in a member."""
    used = calls.filter("receiver <> ''").select("path", "member_ord", "own", "ns", "usings", "receiver", "param_text").distinct()
    place = F.array_position(parameter_names(F.col("param_text")), F.col("receiver")).cast("int")
    given = F.when(place > 0, F.get(parameter_types(F.col("param_text")), place - 1))
    used = used.withColumn("given", given).drop("param_text")
    held = syntax.select("path", F.inline("members")).filter("kind in ('field', 'property')").drop("ns").join(types.parts.select("path", "class_ord", F.col("key").alias("ancestor"), "ns", "usings"), ["path", "class_ord"])
    held = held.select("ancestor", F.col("name").alias("receiver"), "ns", "usings", F.regexp_replace("type_text", NAMING, "").alias("written"), F.struct("path", "ord").alias("place"))
    near = used.filter("given is null").select("own", "receiver").distinct().join(types.lineage.withColumnRenamed("key", "own"), "own").join(held, ["ancestor", "receiver"])
    nearest = near.groupBy("own", "receiver").agg(F.min_by(F.struct("ns", "usings", "written"), F.struct("depth", "place")).alias("held"))
    found = used.join(nearest, ["own", "receiver"], "left")
    said = found.withColumn("said", F.when(F.col("given").isNotNull(), F.struct("ns", "usings", F.col("given").alias("written"))).when(F.col("held").isNotNull(), F.col("held")).otherwise(F.struct("ns", "usings", F.col("receiver").alias("written"))))
    whole = binding.bound(said.select("path", "member_ord", "receiver", "said.ns", "said.usings", "said.written"), types.declared)
    return whole.filter("base is not null").select("path", "member_ord", "receiver", F.col("base").alias("start"))


def misfits(args: Column, kinds: Column) -> Column:
    """How many literal arguments don't fit the parameters in their places."""
    def one(a, k):
        text = F.coalesce(k, F.lit("")).isin("string", "String", "object", "")
        quoted, number = a["literal"].isNotNull(), a["text"].rlike(r"^-?\d")
        return F.when(quoted, (~text).cast("int")).when(number, F.coalesce(k, F.lit("")).isin("string", "String", "bool").cast("int")).otherwise(0)

    return F.aggregate(F.zip_with(args, F.slice(kinds, F.lit(1), F.size(args)), one), F.lit(0), lambda a, x: a + F.coalesce(x, F.lit(0)))


def resolve(callers: DataFrame, types: binding.Types, syntax: DataFrame) -> DataFrame:
    """(path, member_ord, call, to_path, to_ord) of the callers' calls whose method is declared anywhere in the code."""
    calls, targets = graph.cut(calls_of(callers, types)), graph.cut(targets_of(syntax, types))
    key = ["path", "member_ord", "call"]
    held = calls.join(receiver_types(syntax, calls, types), ["path", "member_ord", "receiver"], "left")
    started = held.withColumn("start", F.when(F.col("receiver").isNull(), F.col("own")).otherwise(F.col("start")))
    asked = started.select(*key, "own", "name", "args", "above", "start", F.col("n").alias("given"), F.explode(F.array("n", F.lit(ANY_NUMBER))).alias("n"))
    t = targets.select(F.col("path").alias("to_path"), F.col("ord").alias("to_ord"), "owner", "name", "n", "least", "total", "types", "extension")
    lineage = types.lineage.select(F.col("key").alias("start"), F.col("ancestor").alias("owner"), "depth")
    near = asked.filter("start is not null").join(lineage, "start").filter(~F.col("above") | (F.col("depth") > 0)).join(t, ["owner", "name", "n"]).filter((F.col("n") >= 0) | (F.col("given") >= F.col("least")))
    order = F.struct("depth", misfits(F.col("args"), F.col("types")).alias("misfits"), (F.col("n") < 0).alias("any"), (F.col("total") - F.col("given")).alias("defaults"), "to_path", "to_ord")
    best = near.groupBy(*key).agg(F.min_by(F.struct("to_path", "to_ord"), order).alias("to"))
    # Whatever has no type here may still mean the only such method there is; called on a value, an extension has one parameter more.
    sole = t.withColumn("n", F.when(F.col("extension") & (F.col("n") > 0), F.col("n") - 1).otherwise(F.col("n"))).filter("n >= 0")
    sole = sole.groupBy("name", "n").agg(F.count_distinct("owner").alias("owners"), F.min_by("owner", F.struct("to_path", "to_ord")).alias("owner"), F.min(F.struct("to_path", "to_ord")).alias("to")).filter("owners = 1").drop("owners", "owner")
    left = asked.filter("n >= 0 and not above").join(best.select(*key), key, "left_anti")
    only = left.join(sole, ["name", "n"]).select(*key, "to")
    return best.unionByName(only).select(*key, "to.to_path", "to.to_ord")
