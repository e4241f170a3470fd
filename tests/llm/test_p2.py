from sitegrain.llm.p2_residue import error_pages

BODY = ["Ask for Dr. Ann Lee if you need an interpreter or a map.", "The clinic has treated eczema in Boston since 2004, and 504 staff now work here."]
CONTACT = ["454 Oakfield Terrace, Drehomp, MI", "Open Thursday from 6:30 to 4:00 pm at Oakfield", "Phone (394) 926-9255, fax at the front desk"]
CHROME = ["Follow Oakfield on three networks, 102 people already do", "© 2020 Oakfield. All rights reserved. Pages last built on 3 July 2024."]
LOREM = "Lorem ipsum dolor sit amet, consectetur adipiscing elit, sed do eiusmod tempor incididunt ut labore et dolore magna aliqua. " + "Ut enim ad minim veniam, quis nostrud exercitation ullamco laboris nisi ut aliquip ex ea commodo consequat. " * 4
PAGES = {
    1: (["Some site", *CHROME, *CONTACT], False),  # a house number is no HTTP error
    2: (["404 Not Found", *CHROME], True),
    3: (["503", *CHROME], True),
    4: (["Access denied", *CONTACT], False),  # short lines are content
    5: ([LOREM], True),  # over 400 letters
    6: (["Page not found", " ".join(BODY)], False),  # the body in one block
    7: (["Page not found. " + " ".join(BODY * 5)], False),
    8: (["Error 502: upstream", *CHROME], True),
    9: (["Page not found", *BODY], False),
}


def found(spark, more=()):
    rows = [(n, f"h{n}.test", f"https://h{n}.test/a", "".join(f"<p>{x}</p>" for x in lines)) for n, (lines, _) in PAGES.items()]
    return {r.ord for r in error_pages(spark.createDataFrame([*rows, *more], "ord long, domain string, url string, html string")).collect()}


def test_pages_without_content(spark):
    assert found(spark) == {n for n, (_, bad) in PAGES.items() if bad}


def test_other_hosts_change_nothing(spark):
    more = [(100 + n, f"other{n}.test", f"https://other{n}.test/", "".join(f"<p>{x}</p>" for x in BODY + CONTACT)) for n in range(9)]
    assert found(spark, more) == found(spark)


def test_lines_of_most_pages_of_a_host_are_subtracted(spark):
    line = "Our four clinics are open all year round for you"
    more = [(200 + n, "own.test", f"https://own.test/{n}", f"<p>{line}</p><p>{'Bad gateway' if n == 0 else BODY[0]}</p>") for n in range(4)]
    assert found(spark, more) - found(spark) == {200}
