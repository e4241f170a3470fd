import re

import pytest

from sitegrain.llm.p2_residue import NOTICE


@pytest.mark.parametrize("line", ["557 Brelzovimu Street, Gizimme Falls, SD", "454 Zimluldumvi Terrace, Drehomp, MI", "450 volunteers took part"])
def test_a_number_alone_is_no_http_error(line):
    assert not re.search(NOTICE, line.lower())


@pytest.mark.parametrize("line", ["404", "404 Not Found", "Error 404", "HTTP 503 Service Unavailable", "502 Bad Gateway", "Error 500: try again", "410 Gone"])
def test_http_errors(line):
    assert re.search(NOTICE, line.lower())
