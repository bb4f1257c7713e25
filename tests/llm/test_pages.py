from __future__ import annotations

from veredas.llm.pages import main_content_lines, extract_main_content, main_lines, parse, visible_lines

PAGE = """<!DOCTYPE html>
<head><title></title></head>
<script>
  var a = '<p>no</p>';
</script>
<nav><ul>
<li><a href='/1'>Normas</a></li>
<li><a href='/2'>Archivo</a></li>
</ul></nav>
<p>Usamos cookies. Aceptar | Configurar | Rechazar
<div>
<h1>La c&aacute;mara aprob&oacute; el plan de riego</h1>
<p>Por Ana Ruiz, corresponsal de El Faro
<p>Publicado el 3/4/2025, El Faro
<p>La comisi&oacute;n cit&oacute; a los alcaldes para explicar el fallo parcial del 7
de febrero, que afecta a los cultivos de la cuenca alta.
<h2>En resumen</h2>
<li>Primer punto del acuerdo: 12</li>
<p><em>Lea tambi&eacute;n: Otra nota distinta</em>
<blockquote>V&eacute;ase <a href='/x'>el acta</a> con todos los detalles del acuerdo.</blockquote>
</div>
<h3>Publicaciones recientes</h3>
<p>El auditor public&oacute; el saldo de 847 millones a favor de la cooperativa agraria del valle.
<footer>
<p>T&eacute;rminos de uso · Tratamiento de datos
</footer>"""


def test_article_lines_of_a_malformed_page():
    assert [n for n, _ in main_lines(PAGE, None)] == [12, 15, 16, 17, 18, 20]


def test_visible_lines_keep_their_numbers():
    lines = visible_lines(PAGE)
    assert len(lines) == PAGE.count("\n") + 1
    assert lines[11].strip() == "La cámara aprobó el plan de riego"
    assert lines[3].strip() == "" and lines[9].strip().startswith("Usamos")
    assert visible_lines("a < b\n<br>c&amp;d") == ["a < b", " c&d"]


def test_plain_page_runs_from_its_title_to_its_foot():
    text = "Mapas\nDeportes\nInicio > Mapas > Nota\nTítulo de la nota\nPor Ana Ruiz\nEl texto de la nota.\nLea también: otra\nComentarios de lectores\nAna: falta algo."
    assert [n for n, _ in main_lines(text, "  titulo de la NOTA ")] == [4, 6]
    assert [n for n, _ in main_lines(text, None)] == [4, 6]


def test_feed_entry_loses_its_ending():
    assert [n for n, _ in main_lines("<p>Uno dos.</p>\n\n<p><i>La entrada se publicó primero en X.</i></p>", "T")] == [1]


def test_odd_texts():
    for text in (None, "", "   \n ", "<", "<html>", "<p", "</div></div>", "<html><body><script>x", "<html>" * 3000 + "a", "&" * 1000, "<!-- x"):
        main_lines(text, None)
        main_lines(text, "x")
    long = "<html><body><div><h1>T</h1>" + "<p>Una frase con bastante texto para el cuerpo.</p>\n" * 20_000 + "</div>"
    assert len(main_lines(long, "T")) == 20_000
    assert parse("a</a></b><li>x<li>y")[0][0].chars == 3


def test_operator_on_nulls_repeats_and_extra_columns(spark):
    schema = "pos long, raw_text string, title string, text string, line_numbers int"
    rows = spark.createDataFrame([(1, "uno\n\ndos", None, "z", 3), (1, "uno\n\ndos", None, "z", 3), (2, None, None, None, None), (3, "", "t", None, None), (None, "x", None, None, None)], schema)
    got = sorted(((r.pos, list(r.line_numbers), r.main_text) for r in extract_main_content(rows).collect()), key=str)
    assert got == sorted([(1, [1, 3], "uno\ndos")] * 2 + [(2, [], ""), (3, [], ""), (None, [1], "x")], key=str)
    assert extract_main_content(rows.limit(0)).count() == 0


def test_what_a_source_repeats_goes_without_any_known_phrase(spark):
    rows = []
    for i in range(40):
        body = f"Nota sobre el tema {'abcdefghij'[i % 10]}{'klmn'[i // 10]}\nEl puente {'xyzw'[i % 4]}{'abcdefghij'[i % 10]} cede otra vez\nMire esto: otra cosa {'qrst'[i % 4] * 3}{'abcdefghij'[i // 4]}\nTodos los textos son de Diario {'Uno' if i % 2 else 'Dos'}"
        rows.append((i, f"s{i % 2}", f"i{i}", body, None, 1))
    rows += [(90, None, "x", "Todos los textos son nuestros", None, 1), (91, "s0", None, None, None, 1), (92, "s0", "y", "", None, 1), (0, "s0", "i0", rows[0][3], None, 1)]
    df = spark.createDataFrame(rows, "pos long, source_id string, id string, raw_text string, title string, line_no int")
    got = sorted((r.pos, r.line_no) for r in main_content_lines(df, phrases=False).collect())
    assert got == sorted([(r[0], n) for r in rows if r[0] < 40 for n in (1, 2)])
    assert main_content_lines(df.limit(0)).count() == 0
