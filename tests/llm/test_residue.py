import pytest

from folioflow.llm.residue import kinds, measure, residue

ARTICLE = "The council restored the old archive in May. Researchers found the flaw in a second pump."


@pytest.mark.parametrize("field", ["Dear {{first_name}}, thank you.", "By ${author.name} today.", "Hello {SENDER}, see below.", "Posted on <%= date %> in News.", "The price is [[item.price]] per seat.", "[INSERT CITY HERE]", "[CITY EINFÜGEN]", "[Your company goes here]", "Contact %headline% now.", "<<CITY>> said so.", "Sincerely, <Name of SENDER>", "@@quote@@ spoke.", "Last changed: __quote__", "Name: XXXX (date to be added)", "{% block title %}{% endblock %}", "Votre texte ici (date).", "Welcome back, undefined!", "Your date is NaN.", "Author: #{user.firstName}", "{{ title | default }}"])
def test_unfilled_fields(field):
    assert kinds(f"{ARTICLE} {field} {ARTICLE}") == ["placeholder"]


@pytest.mark.parametrize("text", ["The test string {{7*7}} came back as a number.", "It treats [INSERT_KEY_HERE] in the config as a marker.", "A request holding ${env:Acme_KEY} printed it.", "The bug lies in how it expands %s and %n here.", "The shop still had lorem ipsum in its footer.", "The lure asks people to enable JavaScript before it copied the pump.", 'The kit copies a "verify you are a human" page.', 'Visitors saw "503 Service Unavailable" and nothing else.', "f(x){return x}", "```\n{{name}}\n```", "Write `{{name}}` in the page."])
def test_articles_about_them(text):
    assert kinds(f"{ARTICLE} {text} {ARTICLE}") == []


@pytest.mark.parametrize("text,kind", [("Error 404\n\nThe link may be broken or the page may have been removed.", "error"), ("Whoops, something went wrong", "error"), ("Die angeforderte Seite wurde nicht gefunden.", "error"), ("Ray ID: 2984f6a668d3", "error"), ("Checking your browser. This takes only a moment.", "notice"), ("Loading... please wait while the content is fetched.", "notice"), ("You need to enable JavaScript to run this app.", "notice"), ("Veuillez activer JavaScript pour afficher ce contenu.", "notice"), ("Lorem ipsum dolor sit amet.", "filler"), ("Orci massa dolor nibh magna cursus sed felis. Nunc quam erat vitae orci.", "filler"), ("This is a placeholder post. Edit or delete it, then start writing!", "filler")])
def test_notices_errors_and_filler(text, kind):
    assert kinds(text) == [kind] and kind in kinds(f"{ARTICLE}\n{text}\n{ARTICLE}")


UNSEEN = [
    ("You will need JavaScript switched on before this content can load.", "notice"), ("Ativar o JavaScript para continuar.", "notice"), ("Scripts are turned off in your browser.", "notice"), ("请启用浏览器脚本后继续访问", "notice"), ("Your browser must accept cookies to view this page.", "notice"),
    ("HTTP status 503 returned by origin", "error"), ("Seite nicht verfügbar. Bitte später erneut versuchen.", "error"), ("We could not find the page you requested.", "error"), ("Access to this resource is forbidden for your account.", "error"), ("Your connection to the server timed out.", "error"), ("ページが見つかりませんでした", "error"),
    ("Vul hier uw tekst in", "filler"), ("Insira seu texto aqui.", "filler"), ("Escriba aquí su texto.", "filler"), ("Type your description here.", "filler"),
]


@pytest.mark.parametrize("text,kind", UNSEEN)
def test_wordings_in_no_list(text, kind):
    assert kinds(text) == [kind] and kind in kinds(f"{ARTICLE}\n{text}\n{ARTICLE}")


@pytest.mark.parametrize("text", ["Researchers said that the page you requested could not be found on any server.", "Visitors were told to enable JavaScript in their browser before they could log in.", "The server of Acme Labs could not be reached in May.", "We use cookies and similar tools to run this site.", "The session expired while the council restored the database, Ada Stone said.", "A second request to the database was blocked by the pump, which kept its own link."])
def test_reports_are_no_messages(text):
    assert kinds(f"{ARTICLE} {text} {ARTICLE}") == []


def test_mostly_shown_fields_are_not_unfilled():
    shown = "Write `{{name}}` in the page. The field `{{city}}` is next. Then `{{street}}` follows."
    assert kinds(f"{ARTICLE} {shown} Here {{{{name}}}} is replaced.") == [] and kinds(f"{ARTICLE} Here {{{{name}}}} is replaced.") == ["placeholder"]


def test_density():
    assert measure("Error 404")[1] > 0.9 and 0 < measure(f"{ARTICLE} Dear {{{{first_name}}}}. " + ARTICLE * 20)[1] < 0.05


def test_defined_cases(spark):
    df = spark.createDataFrame([("a", None), ("b", ""), ("c", " "), ("d", "Error 500"), ("d", "Error 500"), ("e", "x" * 200_000), ("f", "{" * 5000)], "pdf_id string, text string")
    assert [r.pdf_id for r in residue(df).distinct().collect()] == ["d"]
