import datetime as dt

import pytest
from conftest import values

from snapflow.operators import snapshot
from snapflow.plans import departments, directory, roles

DAY, TS, OLD = "2026-03-02", dt.datetime(2026, 3, 2), dt.datetime(2026, 3, 1)
HR = "id string, name string, mail string, department string, ckmanager string, title string, timestamp timestamp"


def hr_of(spark, *rows):
    full = [{"name": None, "mail": None, "department": None, "ckmanager": None, "title": None, "timestamp": TS, **r} for r in rows]
    return spark.createDataFrame([tuple(r[c] for c in ("id", "name", "mail", "department", "ckmanager", "title", "timestamp")) for r in full], HR)


# ---------------------------------------------------------------- directory


def test_hr_rows(spark):
    entry = {"sAMAccountName": "sAMAccountName: N1", "givenName": "Ann", "sn": "sn: Lee", "mail": "mail: a@b ", "manager": "manager: CN=N2,OU=D"}
    people = directory.map_attributes(spark.createDataFrame([("CN=N1", entry)], "dn string, attributes map<string,string>"))
    assert tuple(directory.hr_rows(people, DAY).first()) == ("N1", "Ann Lee", "a@b", None, "N2", None, TS)


def test_units_and_accounts(spark):
    entries = spark.createDataFrame([("CN=a,OU=E3,DC=x", {"sAMAccountName": "A1"}), ("CN=b,OU=XE3,DC=x", {"sAMAccountName": "B1"}),
                                     ("CN=c,ou=e3,dc=x", {"sAMAccountName": "C1"})], "dn string, attributes map<string,string>")
    assert directory.people_under(entries, "OU=E3,DC=x").count() == 2
    assert values(directory.people_under(entries, "OU=E3,DC=x", "c1"), "dn") == [("CN=c,ou=e3,dc=x",)]


def test_broken_extract_is_left_out(spark):
    good = lambda: spark.createDataFrame([("A",) * 7], ", ".join(f"{c} string" for c in directory.ATTRIBUTES))
    extract = directory.union_extracts({"one": good, "two": lambda: spark.table("absent_export"), "three": good})
    assert extract.rows.count() == 2 and list(extract.failures) == ["two"]
    assert directory.union_extracts({"x": lambda: spark.table("absent_export")}).rows is None


def test_load_hr_replaces_the_day_even_when_empty(spark, table):
    name = table(HR, "timestamp")
    person = spark.createDataFrame([("A",) * 7], ", ".join(f"{c} string" for c in directory.ATTRIBUTES))
    for day in ("2026-03-01", DAY, DAY):
        directory.load_hr(spark, person, day, name)
    assert values(spark.table(name), "id", "timestamp") == [("A", OLD), ("A", TS)]
    directory.load_hr(spark, person.limit(0), DAY, name)
    assert values(spark.table(name), "id", "timestamp") == [("A", OLD)]


# ---------------------------------------------------------------- departments


def chain_of(spark, start, *pairs, nodes=None):
    hr = hr_of(spark, *[{"id": i, "ckmanager": m} for i, m in pairs])
    starts = spark.createDataFrame([(start,)], "start string")
    rows = departments.manager_chains(starts, departments.manager_edges(hr, DAY), nodes).collect()
    return [r["node"] for r in sorted(rows, key=lambda r: r["depth"])]


def test_chains(spark):
    tree = [("kiln", "oven"), ("oven", "forge"), ("forge", None), ("lone", None), ("self", "self"), ("blank", " \t"), ("gap", "unlisted")]
    assert chain_of(spark, "kiln", *tree) == ["kiln", "oven", "forge"]
    assert chain_of(spark, "forge", *tree) == ["forge"]
    assert chain_of(spark, "gap", *tree) == ["gap", "unlisted"]
    assert chain_of(spark, "blank", *tree) == ["blank"]
    assert chain_of(spark, "self", *tree) == ["self"]
    assert chain_of(spark, "stranger", *tree) == ["stranger"]


@pytest.mark.parametrize("ring", [2, 3, 5])
def test_chain_ends_in_a_ring(spark, ring):
    pairs = [(f"r{i}", f"r{(i + 1) % ring}") for i in range(ring)] + [("tail", "stem"), ("stem", "r0")]
    assert chain_of(spark, "tail", *pairs) == ["tail", "stem", *[f"r{i}" for i in range(ring)]]


def test_long_chain_is_whole_unless_a_limit_is_given(spark):
    pairs = [(str(i), str(i + 1)) for i in range(120)] + [("120", "100")]
    assert chain_of(spark, "0", *pairs) == [str(i) for i in range(121)]
    assert chain_of(spark, "0", *pairs, nodes=50) == [str(i) for i in range(50)]


def test_nearest_lead_against_a_plain_walk(spark):
    import random

    rng = random.Random(7)
    parent = {i: rng.choice([None, *range(max(0, i - 6), min(200, i + 3))]) for i in range(200)} | {i: i + 1 for i in range(200, 280)}
    lead = {i: f"R{i}" for i in rng.sample(range(200), 12)} | {279: "TOP"}
    edges = spark.createDataFrame([(str(k), None if v is None else str(v)) for k, v in parent.items()], "node string, parent string")
    leads = spark.createDataFrame([(str(k), v) for k, v in lead.items()], "ck string, role string")
    expected = {}
    for start in parent:
        at, depth, seen = start, 0, set()
        while at is not None and at not in seen:
            if at in lead:
                expected[str(start)] = (lead[at], depth)
                break
            seen.add(at)
            at, depth = parent.get(at), depth + 1
    got = {r["node"]: (r["role"], r["depth"]) for r in departments.nearest_leads(edges, leads).collect()}
    assert got == expected


@pytest.mark.parametrize("people", [3, 51, 200])
def test_single_chain_reaches_its_lead_from_the_last_person(spark, people):
    """Nobody else is there to keep the work going; a cycle below no lead ends it all the same."""
    chain = [("p0", None)] + [(f"p{i}", f"p{i - 1}") for i in range(1, people)]
    leads = spark.createDataFrame([("p0", "TOP")], "ck string, role string")
    for more in ([], [("x", "y"), ("y", "x"), ("z", "x")]):
        edges = spark.createDataFrame(chain + more, "node string, parent string")
        got = {r["node"]: (r["role"], r["depth"]) for r in departments.nearest_leads(edges, leads).collect()}
        assert got == {f"p{i}": ("TOP", i) for i in range(people)}


ROLES = [(26, "COO_DomainLead"), (32, "CIO_DomainLead"), (5, "Other")]


def classified(spark, staff, assigned, known=(), null_aware=True):
    known_rows = spark.createDataFrame([(k, "x", "y") for k in known], "ID string, DEPARTMENT_TYPE string, DOMAIN string")
    rows, counts = departments.update_departments(
        hr_of(spark, *staff), known_rows, spark.createDataFrame(ROLES, "id int, name string"),
        spark.createDataFrame(assigned, "CK string, ID int"), DAY, null_aware)
    return values(rows), tuple(counts.first())


def test_classification(spark):
    staff = [{"id": "lead", "department": "Known"}, {"id": "coo", "department": "Ops"}, {"id": "e1", "department": "Dev", "ckmanager": "lead"},
             {"id": "e2", "department": "Dev", "ckmanager": "coo"}, {"id": "e3", "department": "Orphan"}, {"id": "e4"},
             {"id": "e5", "department": "OldDept", "timestamp": OLD}]
    rows, counts = classified(spark, staff, [("lead", 32), ("coo", 26), ("e3", 5), ("absent", 32)], known=["Known"])
    assert rows == [("Dev", "IT", "CIO"), ("Ops", "Business", "COO")] and counts == (3, 2)


def test_null_department_id_suppresses_new_ones(spark):
    staff = [{"id": "lead", "department": "New"}]
    assert classified(spark, staff, [("lead", 32)], known=["Known", None]) == ([], (0, 0))
    assert classified(spark, staff, [("lead", 32)], known=["Known", None], null_aware=False)[1] == (1, 1)
    assert classified(spark, staff, [("lead", 32)])[1] == (1, 1)


def test_load_departments(spark, table):
    name = table("ID STRING, DEPARTMENT_TYPE STRING, DOMAIN STRING")
    hr_of(spark, {"id": "lead", "department": "Dev"}).createOrReplaceTempView("ld_hr")
    spark.createDataFrame(ROLES, "id int, name string").createOrReplaceTempView("ld_roles")
    spark.createDataFrame([("lead", 32)], "CK string, ID int").createOrReplaceTempView("ld_assigned")
    assert departments.load_departments(spark, DAY, "ld_hr", name, "ld_roles", "ld_assigned") == (1, 1)
    assert departments.load_departments(spark, DAY, "ld_hr", name, "ld_roles", "ld_assigned") == (0, 0)
    assert values(spark.table(name)) == [("Dev", "IT", "CIO")]


def test_several_lead_roles_and_day(spark):
    hr = hr_of(spark, {"id": "a"}, {"id": "b", "timestamp": OLD})
    leads = departments.domain_leads(spark.createDataFrame([("a", 26), ("a", 32), ("b", 26)], "CK string, ID int"),
                                     spark.createDataFrame(ROLES, "id int, name string"), hr, DAY)
    assert values(leads) == [("a", "COO_DomainLead")]


# ---------------------------------------------------------------- roles


@pytest.fixture
def tables(spark):
    hr = hr_of(spark, {"id": "ceo", "title": "COUNTRY MANAGER V", "name": "Boss"}, {"id": "own", "ckmanager": "ceo", "title": "Tribe Lead X"},
               {"id": "old", "ckmanager": "ceo", "timestamp": OLD}, {"id": "head", "title": "Head of Y", "name": "Ann Lee"})
    frames = {
        "hr": hr,
        "action": spark.createDataFrame([("a1", None, "OPEN", "d", TS), ("a2", " ", "OPEN", "d", TS), ("a3", "x", None, "d", TS), ("a4", "y", "OPEN", "d", TS),
                                         ("a5", "y", "CLOSED", "d", TS)], "id string, action_owner string, status string, delegate_action_owner string, timestamp timestamp"),
        "cmdb": spark.createDataFrame([("c", "ANN lee", TS), ("c2", "ann LEE", TS), ("c3", "boss", OLD)], "id string, asset_owner string, timestamp timestamp"),
        "roles": spark.createDataFrame([(1, "CEO"), (2, "Domain owner"), (3, "Action owner"), (4, "Asset owner"), (9, "CEO"), (5, "Risk owner"), (6, "BCOSPOC")], "id int, name string"),
        "roles_assignation": spark.createDataFrame([("ceo", 23), ("own", 23)], "CK string, ID int"),
    }
    return lambda name: frames[name] if name in frames else spark.table(f"absent_{name}")


def test_rules_run_apart(spark, tables):
    run = roles.run_rules(tables, DAY)
    got = values(run.owners, "role", "owner")
    assert ("Domain owner", "own") in got and ("Action owner", "y") in got and ("Asset owner", "head") in got
    assert [o for r, o in got if r == "Action owner"] == ["y"] and [o for r, o in got if r == "BCO Lead"] == ["ceo", "own"]
    assert not [o for r, o in got if r == "BCOSPOC"]
    assert {"Risk owner", "Business Contract owner", "Process leader"} <= set(run.failures) and "CEO" not in run.failures


def test_unknown_column_fails_only_its_own_rule(spark, tables):
    rules = [roles.Rule("good", "hr", "id"), roles.Rule("bad", "hr", "no_such_column")]
    run = roles.run_rules(tables, DAY, rules)
    assert list(run.failures) == ["bad"] and run.owners.count() == 3


def test_owner_roles_and_counts(spark, tables):
    rows = values(roles.owner_roles(tables, DAY).owners, "owner_id", "role_id")
    assert ("ceo", 9) in rows and ("own", 2) in rows and all(i in (9, 2, 3, 4) for _, i in rows)
    counts = dict(values(roles.ownership_counts(tables, DAY)))
    assert counts == {9: 1, 2: 1, 3: 1, 4: 1}  # the failed rule and the ambiguous one did not run
    assert tuple(roles.result_counts(roles.ownership_counts(tables, DAY)).first()) == (4, 4)


def test_two_ceos_stop_the_domain_owner_rule(spark, tables):
    twin = tables("hr").unionByName(tables("hr").filter("id = 'ceo'").selectExpr("'ceo2' as id", "name", "mail", "department", "ckmanager", "title", "timestamp"))
    both = lambda name: twin if name == "hr" else tables(name)
    assert not [o for r, o in values(roles.run_rules(both, DAY).owners) if r == "Domain owner"]
    assert 2 not in dict(values(roles.ownership_counts(both, DAY)))


def test_replace_owner_roles(spark, tables, table):
    name = table("owner_id STRING, role_id INT, timestamp TIMESTAMP", "timestamp")
    snapshot.append(spark, name, spark.createDataFrame([("x", 1, OLD), ("y", 1, TS)], "owner_id string, role_id int, timestamp timestamp"))
    failures = roles.replace_owner_roles(spark, tables, DAY, name)
    assert "Risk owner" in failures
    rows = values(spark.table(name), "owner_id", "timestamp")
    assert ("x", OLD) in rows and ("y", TS) in rows and ("own", TS) in rows  # y owns an action
    roles.replace_owner_roles(spark, tables, "2026-03-03", name)
    assert len(values(spark.table(name))) == len(rows)


def test_all_27_rules_are_there():
    assert len({r.role for r in roles.RULES}) == 27
