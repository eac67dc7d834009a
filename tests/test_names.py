from carelake.functions.names import camel, camel_safe, clean_headers, snake


def test_camel_safe_fixture():
    assert camel_safe(["AGUJA 18G X 1", "AGUJA 18G X 1", "2% CREMA", "--"]) == [
        "aguja18gX1", "aguja18gX1_2", "c_2Crema", "col"]


def test_camel_variants():
    assert camel("fecha_ingreso_DM") == "fechaIngresoDm"
    assert camel("FECHA_INGRESO", "lower_all") == "fechaIngreso"
    assert camel(" _fecha__pago_ ", "strip_lower") == "fechaPago"
    assert camel("___", "strip_lower") == ""
    assert camel("Numero De Documento", "split_other", sep=" ") == "numeroDeDocumento"


def test_snake_and_clean():
    assert snake("NOMBRE  IPS-SEDE Año") == "nombre_ipssede_ano"
    assert clean_headers(' "Pregunta\n1" ') == "Pregunta 1"
